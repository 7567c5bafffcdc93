"""Small files of the stored layers through Hadoop's file system API, so they
live wherever the layers do: listing, reading, and replacing in one step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


FEW = 4


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p = _path(spark, path)
    return _fs(spark, p).exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    p = _path(spark, folder)
    fs = _fs(spark, p)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    p = _path(spark, path)
    _fs(spark, p).delete(p, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None when it does not exist."""
    p = _path(spark, path)
    fs = _fs(spark, p)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str, unique: str) -> None:
    """Write a small file beside ``path`` and rename it over it: a reader sees
    the old text or the new one, never a part."""
    jvm = spark._jvm
    part, target = _path(spark, f"{path}.{unique}"), _path(spark, path)
    out = _fs(spark, part).create(part, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri() if target.toUri().getScheme() else _fs(spark, target).getUri(),
        spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(part, target, options)


def file_states(spark: SparkSession, files: list[str]) -> dict[str, tuple[int, int]]:
    """path -> (length, modification time) of files: one listing a folder, or
    a look at each file where a folder has few of them."""
    folders: dict[str, set[str]] = {}
    for f in files:
        folders.setdefault(f.rsplit("/", 1)[0], set()).add(f)
    out = {}
    for folder, wanted in folders.items():
        p = _path(spark, folder)
        fs = _fs(spark, p)
        if len(wanted) <= FEW:
            for f in wanted:
                # Paths come escaped from a plan.
                q = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f)) if "%" in f else _path(spark, f)
                status = fs.getFileStatus(q) if fs.exists(q) else None
                out[f] = (status.getLen(), status.getModificationTime()) if status else (-1, -1)
            continue
        by_name = {s.getPath().getName(): s for s in fs.listStatus(p)}
        for f in wanted:
            # Names are compared unescaped.
            status = by_name.get(_path(spark, f).getName()) or by_name.get(
                spark._jvm.java.net.URI(f).getPath().rsplit("/", 1)[-1])
            out[f] = (status.getLen(), status.getModificationTime()) if status else (-1, -1)
    return out


def input_states(spark: SparkSession, df: DataFrame) -> dict[str, tuple[int, int]]:
    """States of the files a DataFrame reads; none if it does not read files."""
    return file_states(spark, df.inputFiles())
