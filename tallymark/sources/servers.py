"""Loading and uniting the extracts of several source servers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators.filters import where
from tallymark.sources.files import read_csv, write_csv
from tallymark.sources.widening import widen
from tallymark.spec import ServerSource

SERVER_COLUMN = "_source_server"


def load_servers(spark: SparkSession, servers: Iterable[ServerSource]) -> dict[str, DataFrame]:
    """One lazy DataFrame per server, each with its own filter."""
    loaded: dict[str, DataFrame] = {}
    for server in servers:
        if server.name in loaded:
            raise ValueError(f"server {server.name!r} is listed twice")
        if server.format == "csv":
            df = read_csv(spark, server.path, server.schema, **server.options)
        else:
            reader = spark.read.format(server.format).options(**server.options)
            df = (reader.schema(server.schema) if server.schema else reader).load(server.path)
        loaded[server.name] = where(df, server.where)
    return loaded


def extract_servers(frames: Mapping[str, DataFrame], folder: str, mode: str = "error") -> list[ServerSource]:
    """Save each server's extract as CSV under ``folder``, and say where each lies."""
    sources = []
    for name, df in frames.items():
        path = f"{folder.rstrip('/')}/{name}"
        write_csv(df, path, mode)
        sources.append(ServerSource(name, path))
    return sources


def tag_server(df: DataFrame, name: str) -> DataFrame:
    """Mark rows with the server they came from."""
    return df.withColumn(SERVER_COLUMN, F.lit(name))


def union_servers(servers: Mapping[str, DataFrame], strict: bool = False, widen_types: bool = False) -> DataFrame:
    """Tag each server's rows and unite them by column name; a column one server lacks is NULL.

    ``strict=True`` first demands the same column names and types of all.
    ``widen_types=True`` gives each column the least type that holds all servers'
    values (see :mod:`tallymark.sources.widening`, which also tells what that loses).
    """
    if not servers:
        raise ValueError("no servers to unite")
    if strict:
        problems = server_disagreements(servers)
        if problems:
            raise ValueError("servers disagree: " + "; ".join(problems))
    if widen_types:
        servers = widen(servers)
    tagged = [tag_server(df, name) for name, df in servers.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def server_disagreements(
    servers: Mapping[str, DataFrame], keys: Mapping[str, Iterable[str]] | None = None
) -> list[str]:
    """How the servers' columns, types and keys differ from the first server's."""
    names = list(servers)
    shape = {n: {f.name.lower(): f.dataType.simpleString() for f in servers[n].schema.fields} for n in names}
    first, problems = names[0], []
    for other in names[1:]:
        absent = sorted(set(shape[first]) - set(shape[other]))
        added = sorted(set(shape[other]) - set(shape[first]))
        if absent:
            problems.append(f"{other} lacks {absent}")
        if added:
            problems.append(f"{other} adds {added}")
        for c in sorted(set(shape[first]) & set(shape[other])):
            if shape[first][c] != shape[other][c]:
                problems.append(f"{c} is {shape[first][c]} in {first} but {shape[other][c]} in {other}")
        if keys is not None:
            mine, theirs = ({k.lower() for k in keys[n]} for n in (first, other))
            if mine != theirs:
                problems.append(f"keys are {sorted(mine)} in {first} but {sorted(theirs)} in {other}")
    return problems
