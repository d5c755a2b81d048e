"""Product pictures: bytes by path.

``stat_pictures`` looks up each product's own picture in the task that holds the row: nothing is listed, on the driver or
elsewhere, and no bytes are read.  ``fetch_factory`` reads one picture where it is needed.  ``read_images`` is the plain
``binaryFile`` scan for folders that are small enough to list, or for stores that only Spark can read.

Paths are plain local paths or URIs of a file system that pyarrow knows (``file:``, ``s3:``, ``hdfs:``, ``gs:``); s3a and
s3n are read as s3.  Pass factories of your own for others.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Fetch = Callable[[str], bytes]
# path -> (length in bytes, time of the last change in ms), or None for a missing file
Stat = Callable[[str], "tuple[int, int] | None"]


def _open(path: str):
    """The file system of a path, and the path inside it."""
    from pyarrow import fs

    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]+:", path):
        if path.startswith("file:"):
            return fs.LocalFileSystem(), re.sub(r"^file:(//)?", "", path)
        return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))
    return fs.LocalFileSystem(), path


def fetch_factory() -> Fetch:
    """Reader of whole files, made once a task."""

    def fetch(path: str) -> bytes:
        system, inside = _open(path)
        with system.open_input_stream(inside) as stream:
            return stream.read()

    return fetch


def save_factory() -> Callable[[str, bytes], None]:
    """Writer of whole files, made once a task; each folder is made once."""
    made: set[str] = set()

    def save(path: str, content: bytes) -> None:
        system, inside = _open(path)
        folder = path.rpartition("/")[0]
        if folder not in made:
            system.create_dir(inside.rpartition("/")[0], recursive=True)
            made.add(folder)
        with system.open_output_stream(inside) as stream:
            stream.write(content)

    return save


def stat_factory() -> Stat:
    """Look-up of files, made once a task."""

    def stat(path: str):
        system, inside = _open(path)
        info = system.get_file_info(inside)
        return (info.size or 0, int((info.mtime_ns or 0) // 1_000_000)) if info.is_file else None

    return stat


def stat_pictures(rows: DataFrame, path_col: str = "prd_img", stats: Callable[[], Stat] = stat_factory) -> DataFrame:
    """``rows`` with ``picture``, the version "length:time" of the file at ``path_col``; null where there is none."""
    schema = T.StructType([*rows.schema.fields, T.StructField("picture", T.StringType())])

    def job(batches: Iterator) -> Iterator:
        stat = stats()
        for pdf in batches:
            found = [stat(p) if p is not None else None for p in pdf[path_col]]
            yield pdf.assign(picture=[f"{f[0]}:{f[1]}" if f else None for f in found])

    return rows.mapInPandas(job, schema)


def read_images(spark: SparkSession, image_dir: str, pattern: str = "*.jpg") -> DataFrame:
    """``binaryFile`` scan of the image folder: path, modificationTime, length, content.  The driver lists the folder."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(image_dir)
    )
