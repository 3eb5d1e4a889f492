"""Writers and the build-once rule."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace the parquet table at ``path``."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """Replace the CSV folder at ``path``; every part file carries the header.

    The parts are written in parallel. A reader that takes the folder sees one table, in
    no promised order; sort after reading where order matters.
    """
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_csv_lines(lines: DataFrame, names: Sequence[str], path: str) -> None:
    """Replace the CSV folder at ``path`` by rows that are CSV text already, in column ``line``.

    Every part file carries the header, as those of ``write_csv`` do, and is compressed:
    a wide table with few values in a row is almost all commas.
    """
    # the first row of a task is the first of its file
    is_first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    header = F.lit(",".join(names) + "\n")
    text = lines.select(F.when(is_first, F.concat(header, "line")).otherwise(F.col("line")).alias("value"))
    text.write.mode("overwrite").option("compression", "lz4").text(path)


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _filesystem(spark, path)
    return fs.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none when it does not exist."""
    fs, hadoop_path = _filesystem(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(entry.getPath().getName() for entry in fs.listStatus(hadoop_path))


def materialize_once(
    spark: SparkSession, path: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """Read the table at ``path``; build and write it first when it is not there.

    The table is written under a name of its own and then renamed, so readers see a whole
    table or none, and a killed job leaves nothing at ``path``. Of two builders at once
    the first to finish is kept, and the other reads its table.
    """
    if not path_exists(spark, f"{path}/_SUCCESS"):
        parent, name = path.rstrip("/").rsplit("/", 1)
        fresh = f"{parent}/_building-{name}-{uuid.uuid4().hex[:12]}"
        build().write.parquet(fresh)
        publish(spark, fresh, path)
    return spark.read.parquet(path)


def publish(spark: SparkSession, fresh: str, path: str) -> None:
    """Give the finished table ``fresh`` the name ``path``, unless a finished table has it.

    A folder at ``path`` without the ``_SUCCESS`` mark, which other writers may have left,
    is replaced. A rename onto a folder that appeared meanwhile moves the table into it,
    under a name with an underscore that readers pass over; it is removed from there.
    """
    fs, to = _filesystem(spark, path)
    source = spark._jvm.org.apache.hadoop.fs.Path(fresh)
    if not path_exists(spark, f"{path}/_SUCCESS"):
        fs.delete(to, True)
        if not fs.rename(source, to) and not path_exists(spark, f"{path}/_SUCCESS"):
            raise OSError(f"cannot rename {fresh} to {path}")
    for left in (source, spark._jvm.org.apache.hadoop.fs.Path(to, source.getName())):
        if fs.exists(left):
            fs.delete(left, True)


def folder_tag(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, bytes and time of the last change of each entry of a folder.

    A folder of part files is one entry: adding, removing or replacing parts changes its
    size or its time, so no part is listed on the driver.
    """
    fs, hadoop_path = _filesystem(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(
        (e.getPath().getName(), fs.getContentSummary(e.getPath()).getLength(), e.getModificationTime())
        for e in fs.listStatus(hadoop_path)
    )
