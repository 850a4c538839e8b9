"""One file from ordered part files."""

from __future__ import annotations

import uuid

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession

from .tables import file_system

#: Bytes that are copied at a time where a store cannot join files itself.
BUFFER = 1 << 20


def part_files(spark: SparkSession, folder: str) -> list:
    """Hadoop paths of a folder's part files that hold bytes, in name order (that of the sorted rows)."""
    fs, p = file_system(spark, folder)
    parts = [st for st in fs.listStatus(p) if st.isFile() and st.getPath().getName().startswith("part-") and st.getLen()]
    return sorted((st.getPath() for st in parts), key=lambda x: x.getName())


def join_files(spark: SparkSession, folder: str, target: str, head: str = "") -> None:
    """Make ``target`` one file: ``head`` and then the part files of ``folder``, which is removed.

    The store joins the files where it can (a change of its metadata only).
    Elsewhere their bytes are copied in order through a buffer of BUFFER bytes. A reader sees the
    old target or the whole new one; a folder of that name is replaced, too.
    """
    fs, source = file_system(spark, folder)
    jvm = spark.sparkContext._jvm
    made = file_system(spark, f"{folder}/_joined")[1]
    out = fs.create(made, True)
    try:
        out.write(bytearray(head.encode()))
    finally:
        out.close()
    parts = part_files(spark, folder)
    if parts and not _concat(spark, fs, made, parts):
        out = fs.create(made, True)
        try:
            out.write(bytearray(head.encode()))
            for part in parts:
                stream = fs.open(part)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, BUFFER, False)
                finally:
                    stream.close()
        finally:
            out.close()
    goal = file_system(spark, target)[1]
    fs.delete(goal, True)
    if not fs.rename(made, goal):
        raise OSError(f"{target} could not be put in place")
    fs.delete(source, True)


def _concat(spark: SparkSession, fs, made, parts: list) -> bool:
    """Let the store append the parts to ``made``; False where it cannot (its files are untouched then)."""
    paths = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Path, len(parts))
    for k, p in enumerate(parts):
        paths[k] = p
    try:
        fs.concat(made, paths)
        return True
    except UnsupportedOperationException:
        return False


def write_one_file(lines: DataFrame, keys: list[str | Column], path: str, head: str = "", line_end: str = "\n") -> None:
    """Write the one text column besides ``keys``' order as one file of lines.

    The sort is distributed: range-partitioned parts are written by many tasks
    and then joined; no row goes through the driver's Python or one task.
    """
    parts = f"{path.rsplit('/', 1)[0]}/_parts_{uuid.uuid4().hex[:12]}"
    lines.orderBy(*keys).select("line").write.option("lineSep", line_end).text(parts)
    join_files(lines.sparkSession, parts, path, head)
