"""Registration of this subpackage's queries with the SQL that checks them."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_ARCHIVE = "tallymark-package.zip"


def query(sql: str | None = None):
    """Register a function as a query under its own name, with its oracle SQL if SQL can express it."""

    def register(fn):
        @wraps(fn)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = shipped
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return shipped

    return register


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, once per application: they need not have it installed."""
    if any(f.endswith(_ARCHIVE) for f in spark.sparkContext.listFiles):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tallymark-")) / _ARCHIVE
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(root.rglob("*.py")):
            out.write(module, module.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
