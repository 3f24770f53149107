"""Helpers the operators of this package share: reading tables, stored steps, files in shared storage."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from tablewatch.session import scratch_path

# A word is a run of characters other than the six ASCII blanks.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ASCII_BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later steps neither recompute it
    nor depend on the executors that made it. The write's shuffle files go as soon as it is done, not
    when the driver happens to collect garbage; should another plan want them, Spark makes them again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        (df if partitions is None else df.coalesce(partitions)).write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a stored step that nothing reads any more, to bound the space a job takes.
    What was made of it must be stored itself."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/tablewatch/" in folder:
            fs, path = filesystem(folder)
            fs.delete_dir(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that clashes with none of ``df``'s (names compare without case)."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(batches, rows: int = 512):
    """Arrow batches in parts, so that few rows at a time are Python objects."""
    for b in batches:
        for start in range(0, b.num_rows, rows):
            yield b.slice(start, rows)


def uri(path: str) -> str:
    """``file:/x`` and plain ``/x`` as ``file:///x``; others unchanged."""
    if path.startswith("file:/") and not path.startswith("file://"):
        return "file://" + path[len("file:"):]
    return "file://" + path if path.startswith("/") else path


def filesystem(path: str):
    """(pyarrow file system, path in it) of a folder or file in shared storage; runs in tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri(path))


@contextlib.contextmanager
def new_file(folder: str, stem: str, suffix: str):
    """Write a file whose name no other attempt of the task shares. Yields (stream, name).

    Tasks may run twice (lost executor, speculation); each attempt writes its own file, and only
    the names that reach the stored result of the job are ever read."""
    name = f"{stem}-{uuid.uuid4().hex}{suffix}"
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/{name}") as out:
        yield out, name
