"""Pipeline tables as Parquet folders under one root (shared storage), published together by stage.

A stage writes its tables and rejects into a folder of its own run; ``publish`` makes them visible all at once by one new
manifest file.  A run that dies before leaves nothing behind that a reader could see.

A table is a list of *entries*, folders of one run each:

* a ``full`` entry replaces the whole table (the default: re-running a stage must not duplicate rows);
* an ``append`` entry adds rows (``insert_ignore``: only keys the table does not hold yet, first row per key winning);
* a ``delta`` entry replaces the rows of its products: of a product only the rows of its last entry are read.

The manifest also notes which entries a stage has read (``seen``).  What is new since then tells the products that the stage
has to work on, so a later run touches only those (``plans/stages.py``).

Column names and types of declared tables are checked on every read; NOT NULL before publication, from the written files
(for Parquet files without nulls a matter of footers).  Rejects of a stage are the table ``rejects/<name>``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.catalog import ORDINAL, insert_ignore
from ..schemas import REJECTS, TABLE_SCHEMAS

KEY = "prd_id"
REJECTS_OF = "rejects/"


class Unpublished(Exception):
    """A table broke its declared schema, so the run was not published."""


class TableStore:
    def __init__(self, spark: SparkSession, root: str, database: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database
        self._open: dict | None = None

    # --- manifest -------------------------------------------------------------------------------------

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _manifests(self) -> list[str]:
        fs, p = self._fs(self.path("manifest"))
        return sorted(str(f.getPath().getName()) for f in fs.listStatus(p) if f.getPath().getName().endswith(".json")) if fs.exists(p) else []

    def _published(self) -> dict:
        names = self._manifests()
        if not names:
            return {"number": 0, "tables": {}, "seen": {}}
        fs, p = self._fs(self.path(f"manifest/{names[-1]}"))
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _state(self) -> dict:
        return self._open if self._open is not None else self._published()

    def _put(self, state: dict) -> None:
        """The next manifest, complete or not at all: written aside, then renamed to a name that must be free."""
        state = state | {"number": state["number"] + 1}
        name = f"{state['number']:09d}.json"
        if name in self._manifests():
            raise Unpublished(f"another run has published {name}")
        fs, aside = self._fs(self.path(f"manifest/.{name}-{uuid.uuid4().hex}"))
        _, final = self._fs(self.path(f"manifest/{name}"))
        stream = fs.create(aside)
        stream.write(json.dumps(state).encode())
        stream.close()
        if not fs.rename(aside, final):
            raise Unpublished(f"another run has published {name}")

    @contextmanager
    def publish(self, stage: str, inputs: Iterable[str] = (), keys: DataFrame | None = None) -> Iterator[str]:
        """All writes inside become visible together at the end; after an error none of them.

        ``inputs`` are tables that the stage has read, now noted as seen.  With ``keys`` (the products worked on) tables are
        written as deltas.  Reads inside see the published state and the run's own writes.
        """
        if self._open is not None:
            raise ValueError("a publication is already open")
        state = self._published()
        read = {stage: {t: [e["path"] for e in state["tables"].get(t, [])] for t in inputs}}
        folder = f"runs/{state['number'] + 1:09d}-{stage}-{uuid.uuid4().hex[:8]}"
        self._open = state | {"folder": folder, "keys": None}
        try:
            if keys is not None:
                self._open["keys"] = f"{folder}/keys"
                keys.select(KEY).distinct().write.parquet(self.path(self._open["keys"]))
            yield folder
            done = {"number": state["number"], "tables": self._open["tables"], "seen": state["seen"] | read}
        finally:
            self._open = None
        self._put(done)

    # --- reading --------------------------------------------------------------------------------------

    def exists(self, name: str) -> bool:
        return name in self._state()["tables"]

    def entries(self, name: str) -> list[dict]:
        found = self._state()["tables"].get(name)
        if found is None:
            raise ValueError(f"no table {name!r} under {self.root}")
        return found

    def _rows(self, name: str, entry: dict) -> DataFrame:
        df = self.spark.table(entry["table"]) if entry.get("table") else self.spark.read.parquet(self.path(entry["path"]))
        declared = TABLE_SCHEMAS.get(name)
        if declared is not None:
            found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
            wanted = {f.name: f.dataType.simpleString() for f in declared.fields}
            if found != wanted:
                raise ValueError(f"{entry['path']} has the columns {found}, {name} is declared with {wanted}")
        return df

    def _keys(self, name: str, entry: dict) -> DataFrame:
        """The products of an entry."""
        if entry["kind"] == "delta":
            return self.spark.read.parquet(self.path(entry["keys"]))
        return self._rows(name, entry).select(KEY).distinct()

    def _current(self, name: str, entries: list[dict], since: int = 0) -> DataFrame:
        """Rows of ``entries`` from ``since`` on, without those of products that a later delta replaces."""
        out = None
        for i in range(since, len(entries)):
            rows = self._rows(name, entries[i])
            for later in entries[i + 1 :]:
                if later["kind"] == "delta":
                    rows = rows.join(self._keys(name, later), KEY, "left_anti").select(*rows.columns)
            out = rows if out is None else out.unionByName(rows)
        return out

    def read(self, name: str) -> DataFrame:
        return self._current(name, self.entries(name))

    def rows_of(self, name: str, keys: DataFrame | None) -> DataFrame:
        """The rows of the given products; all rows without ``keys``."""
        rows = self.read(name)
        return rows if keys is None else rows.join(keys, KEY, "left_semi").select(*rows.columns)

    def _new(self, stage: str, name: str) -> tuple[list[dict], int] | None:
        """Entries of the table, and how many of them the stage has read; None if it has to read the table anew."""
        entries, seen = self.entries(name), self._state()["seen"].get(stage, {}).get(name)
        if not seen or [e["path"] for e in entries[: len(seen)]] != seen:
            return None
        return entries, len(seen)

    def pending(self, stage: str, inputs: Iterable[str]) -> tuple[bool, DataFrame | None]:
        """``(whether the stage has to read its inputs anew, products that are new in them since it last ran)``.

        The products are None where nothing is new.
        """
        keys = None
        for name in inputs:
            new = self._new(stage, name)
            if new is None:
                return True, None
            entries, seen = new
            for entry in entries[seen:]:
                some = self._keys(name, entry)
                keys = some if keys is None else keys.unionByName(some)
        return False, None if keys is None else keys.distinct()

    def new_rows(self, stage: str, name: str) -> DataFrame:
        """Rows of the entries that the stage has not read yet; files of older entries are not opened."""
        new = self._new(stage, name)
        if new is None:
            return self.read(name)
        entries, seen = new
        return self._current(name, entries, seen) if seen < len(entries) else self._rows(name, entries[-1]).limit(0)

    def rejects(self) -> DataFrame:
        """Rejects of all stages, with the stage's name."""
        names = [n for n in self._state()["tables"] if n.startswith(REJECTS_OF)]
        out = self.spark.createDataFrame([], REJECTS)
        for name in sorted(names):
            out = out.unionByName(self.read(name).withColumn("stage", F.lit(name.removeprefix(REJECTS_OF))).select(*REJECTS.fieldNames()))
        return out

    # --- writing --------------------------------------------------------------------------------------

    def _check(self, name: str, path: str) -> None:
        """NOT NULL columns of a declared table, on the written files."""
        needed = [f.name for f in TABLE_SCHEMAS[name].fields if not f.nullable] if name in TABLE_SCHEMAS else []
        if needed:
            bad = self.spark.read.parquet(path).where(" or ".join(f"`{c}` is null" for c in needed))
            if bad.limit(1).count():
                raise Unpublished(f"{name} holds a null in one of its NOT NULL columns {needed}")

    def _add(self, name: str, entry: dict) -> None:
        tables = self._open["tables"]
        self._open["tables"] = tables | {name: [entry] if entry["kind"] == "full" else [*tables.get(name, []), entry]}

    def write(self, df: DataFrame, name: str, kind: str | None = None) -> None:
        """Write a table; ``kind`` is ``full`` (the default; in a publication with keys ``delta``) or ``append``."""
        if self._open is None:
            with self.publish("write"):
                self.write(df, name, kind)
            return
        kind = kind or ("delta" if self._open["keys"] and self.exists(name) else "full")
        path = f"{self._open['folder']}/{name.replace('/', '-')}"
        df.write.mode("errorifexists").parquet(self.path(path))
        self._check(name, self.path(path))
        self._add(name, {"path": path, "kind": kind, "keys": self._open["keys"]})

    def write_rejects(self, rejects: DataFrame, stage: str, kind: str | None = None) -> None:
        """Replace one stage's rejects (other stages' rejects are untouched)."""
        self.write(rejects.select(*[f.name for f in REJECTS.fields if f.name != "stage"]), f"{REJECTS_OF}{stage}", kind)

    def create_all(self) -> None:
        """Create every missing table empty, with its declared schema (idempotent)."""
        missing = [n for n in TABLE_SCHEMAS if not self.exists(n)]
        if missing:
            with self.publish("create"):
                for name in missing:
                    self.write(self.spark.createDataFrame([], TABLE_SCHEMAS[name]), name, "full")

    def insert_ignore(self, rows: DataFrame, name: str = "product_raw", key: str = KEY) -> None:
        """Append rows whose key is new; the first row per key (by ``_ord``) wins."""
        if ORDINAL not in rows.columns:
            raise ValueError(f"insert_ignore needs the input order in a column {ORDINAL!r}")
        existing = self.read(name).select(key) if self.exists(name) else rows.select(key).limit(0)
        new = insert_ignore(rows, existing, key).drop(ORDINAL)
        columns = [f.name for f in TABLE_SCHEMAS[name].fields] if name in TABLE_SCHEMAS else new.columns
        self.write(new.select(*columns), name, "append")

    def write_entities(self, entities: DataFrame, name: str = "product_embedding", buckets: int | None = None) -> None:
        """Write vector entities; with ``buckets`` (and a database) a full table is bucketed and sorted by product."""
        if self._open is None:
            with self.publish("write"):
                self.write_entities(entities, name, buckets)
            return
        if not (buckets and self.database) or (self._open["keys"] and self.exists(name)):
            self.write(entities, name)
            return
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        path = f"{self._open['folder']}/{name}"
        table = f"{self.database}.{name}_{path.split('/')[1].replace('-', '_')}"
        entities.write.bucketBy(buckets, KEY).sortBy(KEY, "id").option("path", self.path(path)).saveAsTable(table)
        self._check(name, self.path(path))
        self._add(name, {"path": path, "kind": "full", "keys": None, "table": table})
