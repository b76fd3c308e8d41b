"""Scratch tables on shared storage.

A frame that is used twice and must not change in between (row positions,
found differences) is written once and read back. The written table outlives
lost executors, ends the lineage, and tells the planner its real size, so a
join against it is broadcast only when it is small.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

DIR_SETTING = "spark.checkpoint.dir"

# every path that this process has given out and not deleted
_given: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the folder that ``spark.checkpoint.dir`` names."""
    base = spark.conf.get(DIR_SETTING, None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError(f"set {DIR_SETTING} to a folder that all executors share")
        base = _local_folder()
    path = f"{base.rstrip('/')}/tallymark/{label}-{uuid.uuid4().hex}"
    _given.append(path)
    return path


@cache
def _local_folder() -> str:
    # one machine only: a test or a trial run
    return tempfile.mkdtemp(prefix="tallymark-")


def stash(df: DataFrame, label: str = "stash") -> DataFrame:
    """Write ``df`` to a scratch table and return the table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the scratch tables that ``df`` reads. It cannot be read afterwards."""
    spark = df.sparkSession
    base = spark.conf.get(DIR_SETTING, None) or _local_folder()
    mark = f"{base.rstrip('/').split('://')[-1].removeprefix('file:')}/tallymark/"
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles() if mark in f}
    for folder in folders:
        _delete(spark, folder)


def release_all(spark: SparkSession) -> int:
    """Delete every scratch folder that this process has written, whichever operator asked for it, and the names of
    bucketed scratch tables. Results that read them cannot be read afterwards. Returns how many folders there were."""
    found = 0
    while _given:
        found += _delete(spark, _given.pop())
    for t in spark.catalog.listTables():
        if re.fullmatch("tallymark_[0-9a-f]{32}", t.name):
            spark.sql(f"DROP TABLE IF EXISTS `{t.name}`")
    return found


def _delete(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
