"""Small files and whole folders of the store that tables lie in, through Hadoop's file system. No table's rows pass here."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def files(spark: SparkSession, folder: str) -> dict[str, int]:
    """Name and bytes of each file below a folder (its path from there), without those that start with _ or a dot."""
    fs, where = _at(spark, folder)
    base, out = fs.makeQualified(where).toString().rstrip("/") + "/", {}
    found = fs.listFiles(where, True)
    while found.hasNext():
        f = found.next()
        name = f.getPath().toString().removeprefix(base)
        if not any(part[0] in "_." and "=" not in part for part in name.split("/")):
            out[name] = f.getLen()
    return out


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all; an error where it is there already."""
    fs, where = _at(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}.new")
    out = fs.create(hidden, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(hidden, where):
        fs.delete(hidden, False)
        raise FileExistsError(path)


def move(spark: SparkSession, old: str, new: str) -> None:
    fs, where = _at(spark, old)
    target = spark._jvm.org.apache.hadoop.fs.Path(new)
    fs.mkdirs(target.getParent())
    if not fs.rename(where, target):
        raise OSError(f"{old} can't be renamed to {new}")


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)
