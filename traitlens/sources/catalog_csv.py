"""Scraped catalog CSV scan: header row, every column a string, nothing inferred.

Values may hold line breaks inside quotes, and still a large file is read in many splits.  Whether a line starts inside
quotes depends on all quotes before it, so the scan goes in two passes over lines:

1. every split counts its quotes; the running parity over a file's splits says which splits start inside quotes;
2. every split cuts its lines into records with that start.  A record belongs to the split it starts in: lines before the
   first record of a split (its head) go back to the record that is open at the end of an earlier split (its tail).  Heads
   and tails, at most two a split, are put together by a window over their places.

The records are written once, as both kinds are read from them.  Only the starts of the splits that begin inside quotes are broadcast, 16 bytes a split (13 MB for 100 TB in splits of 128 MB).
The text of a record is then read by Spark's CSV parser.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.catalog import ORDINAL
from ..session import cut_lineage

CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
_RECORDS = "file string, start long, row long, part string, record string"


def read_catalog_csv(spark: SparkSession, path: str, with_ordinal: bool = True, quoted_newlines: bool = True) -> DataFrame:
    """Read the catalog CSV (RFC-4180 quoting), in splits.

    Without ``inferSchema`` every column is a string.  Empty fields read as null; the other missing-value tokens are mapped
    in ``clean_catalog``.  ``quoted_newlines`` (the default) allows line breaks inside quotes; without them one pass is
    enough.  A quote inside an unquoted field is not RFC-4180: it shifts what counts as quoted.  Line ends are LF or CRLF.
    ``_ord`` is the input order for first-wins deduplication: file path, then the split's place in the file, then the row's
    place in the split; a task retry reproduces it.
    """
    if quoted_newlines:
        return _read_records(spark, path, with_ordinal)
    df = spark.read.options(header=True, inferSchema=False, **CSV_OPTIONS).csv(path)
    if with_ordinal:
        place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row"))
        df = df.withColumn(ORDINAL, place)
    return df


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """The same rows by Spark's own multi-line reader, one task a file."""
    return spark.read.options(header=True, inferSchema=False, multiLine=True, **CSV_OPTIONS).csv(path)


def _cut(batches: Iterator) -> Iterator:
    """Lines of splits, in order -> records, heads and tails."""
    import pyarrow as pa
    import pyarrow.compute as pc

    place, inside, row, open_lines, is_head = None, False, 0, [], False

    def batch(rows):
        files, starts, numbers, parts, records = zip(*rows) if rows else ((),) * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(files, pa.string()), pa.array(starts, pa.int64()), pa.array(numbers, pa.int64()), pa.array(parts, pa.string()), pa.array(records, pa.string())],
            names=["file", "start", "row", "part", "record"],
        )

    def left_open():
        """What a split leaves at its end: the unfinished record, or a head that never closed."""
        if not open_lines:
            return []
        return [(*place, row, "head" if is_head else "tail", "\n".join(open_lines))]

    for lines in batches:
        out = []
        odd = [n % 2 == 1 for n in pc.count_substring(lines["value"], '"').to_pylist()]
        file, start, texts, begins = (lines[c].to_pylist() for c in ("file", "start", "value", "inside"))
        for i in range(len(file)):
            if place != (file[i], start[i]):
                out += left_open()
                place, inside, row, open_lines = (file[i], start[i]), begins[i], 0, []
                is_head = inside
            text = texts[i].removesuffix("\r")
            ends = inside == odd[i]
            if ends and not open_lines and not is_head:
                if text:
                    out.append((*place, row, "record", text))
                    row += 1
            else:
                open_lines.append(text)
                if ends:
                    out.append((*place, 0 if is_head else row, "head" if is_head else "record", "\n".join(open_lines)))
                    row += not is_head
                    open_lines, is_head = [], False
            inside = not ends
        yield batch(out)
    yield batch(left_open())


def _read_records(spark: SparkSession, path: str, with_ordinal: bool) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "start").agg(F.sum(quotes.cast("long")).alias("quotes")).select("file", "start", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    inside = splits.where("inside").select(F.xxhash64("file").alias("file_key"), F.col("start").alias("at"))
    known = lines.join(F.broadcast(inside), (F.xxhash64(lines["file"]) == F.col("file_key")) & (lines["start"] == F.col("at")), "left")
    parts = cut_lineage(known.select("file", "start", "value", F.col("at").isNotNull().alias("inside")).mapInArrow(_cut, _RECORDS), "records")

    # A tail opens a record, the heads after it belong to it.
    place = F.when(F.col("part") == "head", F.col("start") * 2).otherwise(F.col("start") * 2 + 1)
    order = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    loose = parts.where("part <> 'record'").withColumn("place", place)
    joined = (
        loose.withColumn("opened", F.sum((F.col("part") == "tail").cast("long")).over(order))
        .groupBy("file", "opened")
        .agg(F.min(F.struct("place", "start", "row")).alias("first"), F.sort_array(F.collect_list(F.struct("place", "record"))).alias("pieces"))
        .select("file", "first.start", "first.row", F.array_join("pieces.record", "\n").alias("record"))
    )
    records = parts.where("part = 'record'").select("file", "start", "row", "record").unionByName(joined)
    columns = read_whole_files(spark, path).columns
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    body = records.where(~((F.col("start") == 0) & (F.col("row") == 0)))  # the header of each file
    rows = body.select(F.struct("file", "start", "row").alias(ORDINAL), F.from_csv("record", schema, CSV_OPTIONS).alias("r"))
    named = [F.col("r")[c].alias(c) for c in columns]
    return rows.select(*named, ORDINAL) if with_ordinal else rows.select(*named)
