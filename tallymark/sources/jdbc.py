"""JDBC scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.names import col, find

# Driver classes, and the fetch size where none is given.
MYSQL_DRIVER = "com.mysql.cj.jdbc.Driver"
SQLSERVER_DRIVER = "com.microsoft.sqlserver.jdbc.SQLServerDriver"
FETCH_SIZE = 10_000


def jdbc_options(
    kind: str,
    host: str,
    port: int,
    database: str,
    user: str,
    password: str,
    fetch_size: int = FETCH_SIZE,
    encrypt: bool = False,
    trust_certificate: bool = True,
) -> dict[str, str]:
    """Reader options for a MySQL or SQL Server database."""
    kind = kind.strip().lower()
    if kind == "mysql":
        url = f"jdbc:mysql://{host}:{port}/{database}?useSSL=false&allowPublicKeyRetrieval=true"
        driver = MYSQL_DRIVER
    elif kind == "sqlserver":
        settings = {
            "databaseName": database,
            "encrypt": str(encrypt).lower(),
            "trustServerCertificate": str(trust_certificate).lower(),
        }
        url = f"jdbc:sqlserver://{host}:{port};" + "".join(f"{k}={v};" for k, v in settings.items())
        driver = SQLSERVER_DRIVER
    else:
        raise ValueError(f"kind must be 'mysql' or 'sqlserver', not {kind!r}")
    return {"url": url, "driver": driver, "user": user, "password": password, "fetchsize": str(fetch_size)}


def scan_options(
    options: Mapping[str, str],
    query: str,
    partition: tuple | None = None,
) -> dict[str, str]:
    """All options of one scan. ``partition`` is (column, lower, upper, number of partitions), all
    four or none; it splits the query into that many range scans, which run on many executors."""
    query = query.strip().rstrip(";").rstrip()
    scan = {**options, "useCursorFetch": "true"}
    if partition is None:
        return {**scan, "query": query}
    if len(partition) != 4 or any(p is None for p in partition):
        raise ValueError("partition needs a column, a lower and an upper bound and a number of partitions")
    name, lower, upper, count = partition
    if int(count) < 1:
        raise ValueError("the number of partitions must be at least 1")
    return {
        **scan,
        "dbtable": f"({query}) AS scan_query",
        "partitionColumn": name,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(int(count)),
    }


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    query: str,
    partition: tuple | None = None,
    predicates: Sequence[str] = (),
) -> DataFrame:
    """Run a query in the database. Filters and column choices made on the result are pushed down.

    ``partition`` splits it into scans of equal width, ``predicates`` (see
    :func:`scan_predicates`) into one scan for each condition.
    """
    if predicates and partition is not None:
        raise ValueError("give a partition or predicates, not both")
    if predicates:
        scan = scan_options(options, query)
        table = f"({scan.pop('query')}) AS scan_query"
        return spark.read.jdbc(scan.pop("url"), table, predicates=list(predicates), properties=scan)
    return spark.read.format("jdbc").options(**scan_options(options, query, partition)).load()


def partition_bounds(df: DataFrame, name: str) -> DataFrame:
    """Smallest and greatest value of a column, to partition a scan by."""
    c = col(find(df.columns, name, "partition column"))
    return df.agg(F.min(c).alias("lower_bound"), F.max(c).alias("upper_bound"))


def scan_partition(df: DataFrame, name: str, count: int) -> tuple | None:
    """What :func:`read_jdbc` needs to split a scan of ``df`` by a column: its name, its bounds, which are read now,
    and the number of partitions. None for an empty table or a column that holds only NULL: one scan will do."""
    lower, upper = partition_bounds(df, name).first()
    return None if lower is None else (find(df.columns, name, "partition column"), lower, upper, count)


_SKETCHED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def scan_predicates(df: DataFrame, name: str, count: int, accuracy: int = 10_000) -> list[str]:
    """SQL conditions that part a scan of ``df`` by a column into up to ``count`` scans of about equally many rows.

    Their bounds come from a quantile sketch, so that gaps and skew in the
    column do not leave scans empty. A value that alone fills several shares
    gives fewer scans; NULLs go with the first. Each row meets just one condition.
    ``accuracy`` bounds the error of a share: one part in so many.
    """
    if count < 1:
        raise ValueError("the number of scans must be at least 1")
    name = find(df.columns, name, "partition column")
    kind = df.schema[name].dataType
    if not isinstance(kind, _SKETCHED):
        raise ValueError(f"{name}: no quantiles of {kind.simpleString()}")
    shares = [i / count for i in range(1, count)]
    row = df.agg(F.percentile_approx(col(name), shares, max(accuracy, 100 * count)).alias("cuts")).first() if shares else None
    cuts = sorted(set(row["cuts"] or [])) if row else []
    if not cuts:
        return ["1 = 1"]
    ends = [_literal(c) for c in cuts]
    between = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(ends, ends[1:])]
    return [f"{name} < {ends[0]} OR {name} IS NULL", *between, f"{name} >= {ends[-1]}"]


def _literal(value) -> str:
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, datetime):
        return f"'{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"'{value.isoformat()}'"
    raise ValueError(f"no literal for {value!r}")
