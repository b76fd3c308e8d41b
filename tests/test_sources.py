"""CSV, schemas, JDBC options, servers, scratch tables and whole validation runs."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions import rules as R
from tallymark.plans.validation import ValidationJob, run_validation
from tallymark.sources.files import ExtractChanged, KeyRange, read_csv, read_parquet, read_schema, write_csv, write_parquet
from tallymark.sources import scratch
from tallymark.sources.jdbc import jdbc_options, partition_bounds, scan_options
from tallymark.sources.scratch import scratch_path, stash
from tallymark.sources.servers import extract_servers, load_servers, server_disagreements, union_servers
from tallymark.spec import ColumnMap, DeclaredColumn, GlobalRule, LookupJoin, TableMap
from tests.conftest import rows

AWKWARD = [
    None, "", " ", "  x ", "00123", "null", "NULL", "\\N", "\\\\N", "\\", '"', 'a"b', "a,b", "a\nb", "a\r\nb", "\n", "é ü",
    "\ta", "'", "#x", "true",
]


def test_csv_keeps_every_text(spark, tmp_path):
    df = spark.createDataFrame([(i, v, v) for i, v in enumerate(AWKWARD)], "k int, v string, w string")
    write_csv(df, str(tmp_path / "t"))
    assert rows(read_csv(spark, str(tmp_path / "t"))) == rows(df)


def test_csv_keeps_types(spark, tmp_path):
    df = spark.sql("""select cast(1 as tinyint) b, 2L l, 0.1D d, cast('NaN' as double) nan, 12.50BD dec, true t,
        date'2024-02-29' day, timestamp'2024-01-01 01:02:03.123456' ts, timestamp_ntz'2024-01-01 01:02:03.000001' ntz,
        '00123' z, cast(null as int) n""")
    write_csv(df, str(tmp_path / "t"))
    back = read_csv(spark, str(tmp_path / "t"))
    assert back.dtypes == df.dtypes and read_schema(spark, str(tmp_path / "t")) == df.schema
    assert str(back.first()) == str(df.first())


def test_csv_with_a_given_schema(spark, tmp_path):
    (tmp_path / "in.csv").write_text("Code,n,junk\n00123,5,a\n,x,b\n")
    schema = T.StructType().add("code", "string").add("N", "integer")
    with pytest.raises(ValueError, match="absent"):
        read_csv(spark, str(tmp_path / "in.csv"), T.StructType().add("absent", "string"), null_token="")
    df = read_csv(spark, str(tmp_path / "in.csv"), schema, null_token="")
    assert df.columns == ["code", "N"] and rows(df) == [("00123", 5), (None, None)]
    guessed = read_csv(spark, str(tmp_path / "in.csv"), null_token="", infer=True, multi_line=False)
    assert dict(guessed.dtypes)["Code"] == "int"


def test_csv_parts_are_bounded(spark, tmp_path):
    write_csv(spark.range(0, 25, 1, 1), str(tmp_path / "t"), rows_per_file=10)
    assert len(list((tmp_path / "t").glob("part-*.csv"))) == 3
    assert read_csv(spark, str(tmp_path / "t")).count() == 25


def test_empty_table_through_csv(spark, tmp_path):
    write_csv(spark.range(0), str(tmp_path / "t"))
    back = read_csv(spark, str(tmp_path / "t"))
    assert back.columns == ["id"] and back.count() == 0


def test_parquet(spark, tmp_path):
    write_parquet(spark.range(3), str(tmp_path / "p"))
    assert read_parquet(spark, str(tmp_path / "p")).count() == 3


def test_jdbc_options():
    mysql = jdbc_options("MySQL", "h", 3306, "d", "u", "p")
    assert mysql == {
        "url": "jdbc:mysql://h:3306/d?useSSL=false&allowPublicKeyRetrieval=true", "driver": "com.mysql.cj.jdbc.Driver",
        "user": "u", "password": "p", "fetchsize": "10000",
    }
    sqlserver = jdbc_options("sqlserver", "h", 1433, "d", "u", "p", fetch_size=50, encrypt=True)
    assert sqlserver["url"] == "jdbc:sqlserver://h:1433;databaseName=d;encrypt=true;trustServerCertificate=true;"
    assert sqlserver["driver"] == "com.microsoft.sqlserver.jdbc.SQLServerDriver" and sqlserver["fetchsize"] == "50"
    with pytest.raises(ValueError, match="kind"):
        jdbc_options("oracle", "h", 1, "d", "u", "p")


def test_jdbc_scan_options():
    assert scan_options({"url": "x"}, "select 1;\n") == {"url": "x", "useCursorFetch": "true", "query": "select 1"}
    split = scan_options({"url": "x"}, "select * from t", ("id", 1, 900, 8))
    assert split == {
        "url": "x", "useCursorFetch": "true", "dbtable": "(select * from t) AS scan_query", "partitionColumn": "id",
        "lowerBound": "1", "upperBound": "900", "numPartitions": "8",
    }
    for bad in (("id", 1, 2), ("id", None, 2, 3), ("id", 1, 2, 0)):
        with pytest.raises(ValueError):
            scan_options({}, "select 1", bad)


def test_partition_bounds(spark):
    assert tuple(partition_bounds(spark.range(5, 9), "ID").first()) == (5, 8)


def test_servers(spark, tmp_path):
    frames = {"north": spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"),
              "south": spark.createDataFrame([(3, None)], "k int, v string")}
    sources = extract_servers(frames, str(tmp_path))
    sources = [replace(sources[0], where="k > 1"), replace(sources[1], where=F.col("k") > 1)]
    loaded = load_servers(spark, sources)
    assert rows(union_servers(loaded, strict=True)) == [(2, "b", "north"), (3, None, "south")]
    with pytest.raises(ValueError, match="twice"):
        load_servers(spark, [sources[0], sources[0]])
    with pytest.raises(ValueError, match="no servers"):
        union_servers({})


def test_server_disagreements(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, 2.0)], "K bigint, w double")
    assert server_disagreements({"a": a, "b": a}, {"a": ["k"], "b": ["K"]}) == []
    problems = server_disagreements({"a": a, "b": b}, {"a": ["k"], "b": ["w"]})
    assert len(problems) == 4
    with pytest.raises(ValueError, match="disagree"):
        union_servers({"a": a, "b": b}, strict=True)
    assert union_servers({"a": a, "b": b}).columns == ["k", "v", "_source_server", "w"]


def test_scratch_is_shared_or_refused(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(base)
    assert rows(stash(spark.range(3))) == [(0,), (1,), (2,)]


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Session:
    def __init__(self, **values):
        self.conf = _Conf({k.replace("__", "."): v for k, v in values.items()})


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(_Session(spark__master="yarn"), "x")
    shared = _Session(**{"spark.checkpoint.dir": "hdfs://c/dir/"})
    assert scratch_path(shared, "x").startswith("hdfs://c/dir/tallymark/x-")
    assert "tallymark" in scratch_path(_Session(spark__master="local[2]"), "x")


def test_validation_run(spark, tmp_path):
    """Two servers with different columns, a lookup, filters, a partial set and a report."""
    cities = spark.createDataFrame([(1, "Ulm"), (2, "Bonn")], "id int, city string")
    north = spark.createDataFrame(
        [(1, " a ", 1, dt.date(2024, 1, 1)), (2, "b", 2, dt.date(2024, 6, 1)), (9, "old", 1, dt.date(2020, 1, 1))],
        "id int, name string, city_id int, day date",
    )
    south = spark.createDataFrame([(3, "C", "Kiel", dt.date(2024, 3, 1))], "nr int, title string, town string, day date")
    extracts = extract_servers({"north": north, "south": south}, str(tmp_path / "in"))
    shape = {"dtype": "VARCHAR(20)"}
    maps = {
        "north": TableMap(
            [ColumnMap("ID", "id", dtype="INT", key=True, null_handling="error"), ColumnMap("NAME", "name", R.upper(), **shape),
             ColumnMap("CITY", "city", **shape), ColumnMap("DAY", "day", dtype="DATE")],
            [GlobalRule(1, "TRIM", (), "dtype:VARCHAR")], [LookupJoin(cities, [("city_id", "id")], "left", ["city"])],
        ),
        "south": TableMap(
            [ColumnMap("ID", "nr", dtype="INT", key=True), ColumnMap("NAME", "title", **shape),
             ColumnMap("CITY", "town", **shape), ColumnMap("DAY", "day", dtype="DATE")],
        ),
    }
    target = spark.createDataFrame(
        [(1, "A", "Ulm", dt.date(2024, 1, 1)), (2, "B", "Köln", dt.date(2024, 6, 1)), (4, "D", "Ulm", dt.date(2024, 2, 2))],
        "id int, name string, city string, day date",
    )
    job = ValidationJob(
        extracts, maps, lambda s: target, ["ID"], declared=[DeclaredColumn("ID", "INT", False), DeclaredColumn("NAME", "VARCHAR(1)")],
        date_range={"mode": "range", "date_from": "2024-01-01", "from_col": "day"}, report_path=str(tmp_path / "report"),
        source_declared={"north": [DeclaredColumn("id", "INT", False), DeclaredColumn("gone", "DATE")]},
    )
    outcome = run_validation(spark, job)
    assert outcome.exit_code == 3
    assert {(r[0], r[1], r[2], r[3], r[4]) for r in outcome.result.diff.collect()} == {
        ("2", "north", "city", "Bonn", "Köln"), ("3", "south", "<ENTIRE_ROW>", "<PRESENT_IN_SOURCE>", "<MISSING_IN_TARGET>"),
        ("4", "N/A", "<ENTIRE_ROW>", "<EXTRA_IN_TARGET>", "<PRESENT_IN_TARGET>"),
    }
    assert {r["column_name"] for r in outcome.conformance.collect()} == {"city", "day"}
    assert [tuple(r)[:2] for r in outcome.source_conformance["north"].collect()] == [("gone", "MISSING_COLUMN")]
    partial = run_validation(spark, replace(job, partial=["name"], date_range={}, key_filter={
        "keys": "ID", "mode": "set", "values": [1, 2]}, report_path=None))
    assert partial.exit_code == 0 and partial.result.counts.matched_rows == 2
    assert run_validation(spark, replace(job, on_issue="fail")).exit_code == 2
    lost = run_validation(spark, replace(job, servers=[*extracts, replace(extracts[0], name="west", path=str(tmp_path / "none"))]))
    assert lost.exit_code == 2 and set(lost.failures) == {"west"} and lost.result.counts.source_rows == 3
    forced = {**maps, "north": replace(maps["north"], columns=[
        replace(c, force_dtype="NUMBER(10,2)") if c.target == "NAME" else c for c in maps["north"].columns])}
    assert run_validation(spark, replace(job, maps=forced)).result.counts == outcome.result.counts
    uneven = {**maps, "south": TableMap([ColumnMap("ID", "nr", key=True)])}
    with pytest.raises(ValueError, match="disagree"):
        run_validation(spark, replace(job, maps=uneven))


def test_a_large_csv_file_is_split(spark, tmp_path):
    write_csv(spark.range(0, 40_000, 1, 1).selectExpr("id", "concat('line\\n', id) t"), str(tmp_path / "t"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        back = read_csv(spark, str(tmp_path / "t"))
        assert len(list((tmp_path / "t").glob("part-*.csv"))) == 1 and back.rdd.getNumPartitions() > 3
        assert back.filter("t = concat('line\\n', id)").count() == 40_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_partition_from_bounds(spark):
    from tallymark.sources.jdbc import scan_partition

    assert scan_partition(spark.range(3, 10), "ID", 4) == ("id", 3, 9, 4)
    assert scan_partition(spark.range(0), "id", 4) is None
    assert scan_partition(spark.sql("select cast(null as bigint) id"), "id", 4) is None


def test_files_of_others_keep_their_backslashes(spark, tmp_path):
    path = str(tmp_path / "foreign")
    rows_ = [("C:\\new\\red", 1), ("C:\\src", 2), ("a\\sb", 3)]
    df = spark.createDataFrame(rows_, "t string, n int")
    df.write.options(header="true", escape='"').csv(path)
    assert rows(read_csv(spark, path, df.schema)) == sorted(rows_, key=repr)
    own = str(tmp_path / "own")
    write_csv(df, own)
    assert rows(read_csv(spark, own)) == rows(read_csv(spark, own, null_token="NULL")) == sorted(rows_, key=repr)


def test_a_changed_extract_is_refused(spark, tmp_path):
    path = tmp_path / "extract"
    write_csv(spark.range(3000).repartition(3), str(path), rows_per_file=500)
    assert read_csv(spark, str(path), verify="rows").count() == 3000
    part = sorted(path.glob("part-*.csv"))[0]
    (path / f".{part.name}.crc").unlink()  # the local file system's own checksum
    kept = part.read_text()
    part.unlink()
    with pytest.raises(ExtractChanged, match="is missing"):
        read_csv(spark, str(path))
    assert read_csv(spark, str(path), verify="off").count() < 3000
    lines = kept.splitlines()
    part.write_text("\n".join(lines[:-1]) + "\n")
    with pytest.raises(ExtractChanged, match="another size"):
        read_csv(spark, str(path))
    # the same size, another row
    digit = "9" if lines[-1][-1] != "9" else "8"
    part.write_text("\n".join([*lines[:-1], lines[-1][:-1] + digit]) + "\n")
    read_csv(spark, str(path))
    with pytest.raises(ExtractChanged, match="other rows"):
        read_csv(spark, str(path), verify="rows")
    part.write_text(kept)
    (path / "part-99999.csv").write_text("id\n5\n")
    with pytest.raises(ExtractChanged, match="is unknown"):
        read_csv(spark, str(path))


def test_ranges_leave_files_unread(spark, tmp_path):
    path = str(tmp_path / "ranged")
    data = spark.range(4000).select("id", F.when(F.col("id") % 9 > 0, F.concat(F.lit("n"), "id")).alias("name"))
    write_csv(data.repartitionByRange(8, "id"), path, ranges=["ID", "name"])
    some = read_csv(spark, path, key_range=KeyRange("id", 100, 180))
    assert sorted(r["id"] for r in some.collect()) == list(range(100, 181)) and len(some.inputFiles()) == 1
    assert len(read_csv(spark, path).inputFiles()) == 8
    assert read_csv(spark, path, key_range=KeyRange("id", least=3990)).count() == 10
    assert read_csv(spark, path, key_range=KeyRange("id", 90000)).count() == 0
    assert read_csv(spark, path, key_range=KeyRange("name", "n17", "n17")).count() == 1
    # a column without ranges is filtered row by row
    plain = str(tmp_path / "plain")
    write_csv(data, plain)
    assert read_csv(spark, plain, key_range=KeyRange("id", 5, 6)).count() == 2


def test_appended_and_empty_extracts(spark, tmp_path):
    path = str(tmp_path / "more")
    write_csv(spark.range(5), path)
    write_csv(spark.range(7), path, mode="append")
    assert read_csv(spark, path, verify="rows").count() == 12
    nothing = str(tmp_path / "none")
    write_csv(spark.range(0), nothing)
    assert read_csv(spark, nothing, verify="rows").collect() == []
    with pytest.raises(ValueError, match="verify"):
        read_csv(spark, path, verify="all")


def test_release_all_leaves_nothing(spark, monkeypatch):
    """Whatever an operator has written goes, tables of other processes and other tables stay."""
    monkeypatch.setattr(scratch, "_given", [])
    kept = stash(spark.range(4), "mine")
    path = scratch_path(spark, "bucketed")
    name = "tallymark_" + "0" * 32
    spark.range(5).write.bucketBy(2, "id").option("path", path).saveAsTable(name)
    never = scratch_path(spark, "never written")
    assert kept.count() == 4 and spark.table(name).count() == 5
    assert scratch.release_all(spark) == 2 and scratch.release_all(spark) == 0
    assert not [t for t in spark.catalog.listTables() if t.name == name] and never
    with pytest.raises(Exception):
        spark.read.parquet(path)
