"""Small file operations on shared storage, by Hadoop's file system, so that any scheme Spark reads works.

They move and name folders that Spark jobs wrote and create small marker files; rows never pass here.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

OLD_SUFFIX = "__old"
NEW_SUFFIX = "__new"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs(spark, source)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not rename {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str = "") -> bool:
    """Make a file that must not exist yet, whole at once; ``False`` if another writer was first.

    The text is written under a private name and then published under ``path``: by a hard link on a
    local file system, elsewhere by a rename that refuses an existing target."""
    fs, p = _fs(spark, path)
    jvm = spark._jvm
    fs.mkdirs(p.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.getScheme() == "file":
        try:
            os.link(draft.toUri().getPath(), p.toUri().getPath())
            return True
        except FileExistsError:
            return False
        finally:
            fs.delete(draft, False)
    none = jvm.org.apache.hadoop.fs.Options.Rename.valueOf("NONE")
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = none
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, p, options)
        return True
    except Exception as err:  # noqa: BLE001 - told apart by its Java class
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in str(err):
            return False
        raise


def staging_name(target: str) -> str:
    """A private sibling of ``target`` for its next version."""
    return f"{target.rstrip('/')}{NEW_SUFFIX}-{uuid.uuid4().hex[:12]}"


def restore_folder(spark: SparkSession, target: str) -> None:
    """Undo a swap that was cut off between its two renames: the version put aside comes back."""
    old = target.rstrip("/") + OLD_SUFFIX
    if not exists(spark, target) and exists(spark, old):
        rename(spark, old, target)


def publish_folder(spark: SparkSession, staged: str, target: str) -> None:
    """Make a complete staged folder the target: the version before is put aside, the new one gets the
    name, and only then the old one goes. If the second rename fails, the first is undone."""
    target = target.rstrip("/")
    old = target + OLD_SUFFIX
    if exists(spark, target):
        delete(spark, old)
        rename(spark, target, old)
    try:
        rename(spark, staged, target)
    except Exception:
        restore_folder(spark, target)
        raise
    delete(spark, old)


def move_files(spark: SparkSession, staged: str, target: str) -> None:
    """Move the data files of a staged folder into ``target`` and drop the folder. Spark's file names are
    unique, so several writers may do this to one target at once."""
    fs, p = _fs(spark, target)
    fs.mkdirs(p)
    for name in children(spark, staged):
        if not name.startswith(("_", ".")):
            rename(spark, f"{staged}/{name}", f"{target.rstrip('/')}/{name}")
    delete(spark, staged)
