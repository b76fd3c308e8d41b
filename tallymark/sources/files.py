"""File scans and sinks.

A CSV folder written here has two companions: ``<folder>.schema`` holds the
schema, ``<folder>.manifest`` one row per file with its size, its rows, a digest
of them and the ranges of named columns, and how text was escaped. Readers hold
the folder against the manifest, and leave out files that a range excludes.
Folders without a manifest are read as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from tallymark.functions.casts import safe_cast
from tallymark.functions.names import col, find

# Written for NULL, so that an empty string stays an empty string.
NULL_TOKEN = "\\N"

# Fixed value: rows per CSV part file.
ROWS_PER_FILE = 100_000

# The columns of a difference report.
DIFF_COLUMNS = (
    "primary_key_value",
    "source_server",
    "column_name",
    "expected_value",
    "actual_value",
    "diff_type",
)
DIFF_SCHEMA = StructType([StructField(name, StringType(), True) for name in DIFF_COLUMNS])

_CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)


def schema_path(path: str) -> str:
    """Where the schema of the CSV folder ``path`` lies."""
    return path.rstrip("/") + ".schema"


def manifest_path(path: str) -> str:
    """Where the manifest of the CSV folder ``path`` lies."""
    return path.rstrip("/") + ".manifest"


class ExtractChanged(ValueError):
    """A CSV folder that is not what its manifest says."""


def write_csv(
    df: DataFrame, path: str, mode: str = "error", rows_per_file: int = ROWS_PER_FILE, ranges: Sequence[str] = ()
) -> None:
    """Write a folder of CSV files with headers, and beside it the schema as JSON and a manifest.

    Reading back with :func:`read_csv` gives the same values: NULL, empty text,
    outer spaces, line breaks and microseconds all survive. The manifest comes
    from reading the files back once; their rows must be as many as were
    written. ``ranges`` names columns whose least and greatest value it keeps for
    each file, so that readers can skip files.
    """
    spark = df.sparkSession
    ranged = [find(df.columns, c, "range column") for c in ranges]
    before = _listing(spark, path) if mode == "append" else None
    kept = before.count() if before is not None else 0
    known = _manifest(spark, path) if kept else None
    held = known.agg(F.sum("rows")).first()[0] if known is not None else 0
    if kept and known is None:
        raise ValueError(f"{path} has no manifest to append to")
    watch = Observation("written")
    (
        df.select(*[_mapped(f, _escape) for f in df.schema.fields]).observe(watch, F.count(F.lit(1)).alias("rows"))
        .write.mode(mode)
        .options(**_CSV_OPTIONS)
        .option("nullValue", NULL_TOKEN)
        .option("emptyValue", '""')
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )
    mode = "overwrite" if mode == "append" else mode  # what lies beside the folder is written anew
    spark.createDataFrame([(df.schema.json(),)], "schema string").coalesce(1).write.mode(mode).text(schema_path(path))
    stats = _file_stats(spark, path, df.schema, ranged)
    described = _listing(spark, path).join(stats, "file", "left").select(
        "file", "bytes", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("low", F.lit(0)).alias("low"),
        F.coalesce("high", F.lit(0)).alias("high"), F.lit(True).alias("escaped"), F.lit(NULL_TOKEN).alias("null_token"),
        "ranges",
    )
    read_back = Observation("read back")
    described.observe(read_back, F.sum("rows").alias("rows")).write.mode(mode).json(manifest_path(path))
    found = read_back.get["rows"] or 0
    if found != watch.get["rows"] + held:
        raise ExtractChanged(f"{path} holds {found} row(s), but {watch.get['rows'] + held} were written")


_MANIFEST = (
    "file string, bytes bigint, rows bigint, low bigint, high bigint, escaped boolean, null_token string, "
    "ranges array<struct<column:string,least:string,most:string,nulls:bigint>>"
)


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """Name and size of each file of a folder; none where there is no folder. No content is read."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv*").load(path)
    except AnalysisException:
        return spark.createDataFrame([], "file string, bytes bigint")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), col("length").alias("bytes"))


def _manifest(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_MANIFEST).json(manifest_path(path))
    except AnalysisException:
        return None


def _file_stats(spark: SparkSession, path: str, schema: StructType, ranged: Sequence[str], files: Sequence[str] = ()) -> DataFrame:
    """Rows of each file, the sum of their hashes in two halves, which no order of rows changes, and ranges."""
    reader = spark.read.options(**_CSV_OPTIONS).options(nullValue=NULL_TOKEN, emptyValue="")
    text = StructType([StructField(f.name, StringType()) for f in schema.fields])
    raw = reader.schema(text).csv([f"{path.rstrip('/')}/{f}" for f in files] or path)
    cells = [p for c in raw.columns for p in (col(c), col(c).isNull())]
    whole = F.xxhash64(F.lit("row"), *cells)
    values = {c: safe_cast(col(c), schema[c].dataType) if not isinstance(schema[c].dataType, StringType) else col(c) for c in ranged}
    counted = raw.select(
        F.input_file_name().alias("file"),
        whole.alias("whole"), *[v.alias(f"_tm_r{i}") for i, v in enumerate(values.values())],
    ).groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(col("whole").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.sum(F.shiftrightunsigned("whole", 32)).alias("high"),
        F.array(*[
            F.struct(
                F.lit(c).alias("column"), F.min(f"_tm_r{i}").cast("string").alias("least"),
                F.max(f"_tm_r{i}").cast("string").alias("most"), F.count_if(col(f"_tm_r{i}").isNull()).alias("nulls"),
            )
            for i, c in enumerate(values)
        ]).cast("array<struct<column:string,least:string,most:string,nulls:bigint>>").alias("ranges"),
    )
    return counted.withColumn("file", F.element_at(F.split("file", "/"), -1))


def verify_extract(spark: SparkSession, path: str, content: bool = False) -> None:
    """Raise :class:`ExtractChanged` if a folder lacks files of its manifest, has others, or files of other sizes; with
    ``content`` also if their rows are not those written, which reads them all."""
    known = _manifest(spark, path)
    if known is None:
        raise ValueError(f"{path} has no manifest")
    _hold_against(spark, path, known, content)


def _hold_against(spark: SparkSession, path: str, known: DataFrame, content: bool) -> tuple[bool, str | None]:
    """Whether text is escaped, and the NULL token, once the folder is what its manifest says."""
    found = _listing(spark, path).select("file", col("bytes").alias("found_bytes"))
    problem = (
        F.when(col("found_bytes").isNull(), "is missing").when(col("bytes").isNull(), "is unknown")
        .when(col("bytes") != col("found_bytes"), "has another size")
    )
    facts = known.join(found, "file", "full").withColumn("problem", problem).agg(
        F.bool_or("escaped").alias("escaped"), F.max("null_token").alias("null_token"),
        F.slice(F.collect_list(F.when(col("problem").isNotNull(), F.struct("file", "problem"))), 1, 10).alias("wrong"),
    ).first()
    wrong = [tuple(w) for w in facts["wrong"]]
    if content and not wrong:
        stats = _file_stats(spark, path, read_schema(spark, path), ()).select(
            "file", col("rows").alias("n"), col("low").alias("l"), col("high").alias("h")
        )
        same = (col("rows") == F.coalesce("n", F.lit(0))) & (col("low") == F.coalesce("l", F.lit(0))) & (
            col("high") == F.coalesce("h", F.lit(0))
        )
        wrong = [(r["file"], "has other rows") for r in known.join(stats, "file", "left").filter(~same).limit(10).collect()]
    if wrong:
        raise ExtractChanged(f"{path}: " + "; ".join(f"{f} {w}" for f, w in sorted(wrong)))
    return bool(facts["escaped"]), facts["null_token"]


@dataclass(frozen=True)
class KeyRange:
    """Rows of a CSV folder to read: ``least <= column <= most``, an end that is None being open."""

    column: str
    least: object = None
    most: object = None

    def holds(self, c: Column, kind) -> Column:
        low = F.lit(True) if self.least is None else c >= F.lit(self.least).cast(kind)
        return low & (F.lit(True) if self.most is None else c <= F.lit(self.most).cast(kind))


def _files_in_range(known: DataFrame, schema: StructType, wanted: KeyRange) -> list[str]:
    """Files whose range meets the wanted one, and those whose range is not known."""
    name = find(schema.names, wanted.column, "range column")
    kind = schema[name].dataType
    own = F.element_at(F.filter("ranges", lambda r: r["column"] == name), 1)
    ends = known.withColumn("own", F.when(F.exists(F.coalesce("ranges", F.array()), lambda r: r["column"] == name), own))
    least, most = (col("own")[e].cast(kind) for e in ("least", "most"))
    meets = F.lit(True)
    if wanted.least is not None:
        meets = meets & (most >= F.lit(wanted.least).cast(kind))
    if wanted.most is not None:
        meets = meets & (least <= F.lit(wanted.most).cast(kind))
    return [r["file"] for r in ends.filter(col("own").isNull() | meets).filter("rows > 0").select("file").collect()]


def read_schema(spark: SparkSession, path: str) -> StructType:
    """The schema that :func:`write_csv` put beside ``path``."""
    import json

    row = spark.read.option("wholetext", "true").text(schema_path(path)).first()
    return StructType.fromJson(json.loads(row[0]))


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    null_token: str | None = None,
    infer: bool = False,
    multi_line: bool = False,
    verify: str = "files",
    key_range: KeyRange | None = None,
) -> DataFrame:
    """Read CSV with its schema, so that ``00123`` stays text where the schema says text.

    Without ``schema`` the one beside the folder is used. Columns are found by
    the header; those the schema does not list are left out, and one that it
    lists and the file lacks is an error. ``infer=True`` guesses the types
    instead, for files nobody described. Large files are split over tasks;
    files of others whose values hold line breaks need ``multi_line=True``,
    which reads each file in one task.

    Where :func:`write_csv` left a manifest, escaped text is restored, and the
    folder must have the files and sizes that it lists (``verify="rows"``: and
    the rows, ``"off"``: nothing is tested). Without one, text is left alone.
    ``key_range`` reads only rows of a range of one column, and only the files
    that may have some.
    """
    if verify not in ("files", "rows", "off"):
        raise ValueError(f"verify must be 'files', 'rows' or 'off', not {verify!r}")
    known = _manifest(spark, path)
    escaped, written_token = False, None
    if known is not None and verify == "off":
        escaped, written_token = known.agg(F.bool_or("escaped"), F.max("null_token")).first()
    elif known is not None:
        escaped, written_token = _hold_against(spark, path, known, content=verify == "rows")
    token = null_token if null_token is not None else written_token or NULL_TOKEN
    reader = spark.read.options(**_CSV_OPTIONS).options(
        nullValue=token, emptyValue="", multiLine=str(multi_line).lower()
    )
    if infer:
        return reader.option("inferSchema", "true").csv(path)
    schema = schema or read_schema(spark, path)
    where: str | list[str] = path
    if key_range is not None and known is not None:
        files = _files_in_range(known, schema, key_range)
        if not files:
            return spark.createDataFrame([], schema)
        where = [f"{path.rstrip('/')}/{f}" for f in files]
    # every value is read as text under the header's names, then cast to the schema's type
    raw = reader.csv(where)
    names = {c.lower(): c for c in raw.columns}
    if not names:
        return spark.createDataFrame([], schema)
    absent = [f.name for f in schema.fields if f.name.lower() not in names]
    if absent:
        raise ValueError(f"{path} lacks column(s) {absent}; it has {raw.columns}")
    out = []
    for f in schema.fields:
        c = col(names[f.name.lower()])
        if isinstance(f.dataType, StringType):
            out.append((_unescape(c) if escaped else c).alias(f.name))
        else:
            out.append(safe_cast(c, f.dataType).alias(f.name))
    rows = raw.select(*out)
    if key_range is None:
        return rows
    name = find(schema.names, key_range.column, "range column")
    return rows.filter(key_range.holds(col(name), schema[name].dataType))


def _mapped(field: StructField, fn) -> Column:
    c = col(field.name)
    return fn(c).alias(field.name) if isinstance(field.dataType, StringType) else c


# How text is written, so that a record is one line and no text reads as the NULL token.
_ESCAPES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))


def _escape(c: Column) -> Column:
    for plain, written in _ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(written))
    return c


def _unescape(c: Column) -> Column:
    for plain, written in reversed(_ESCAPES):
        c = F.replace(c, F.lit(written), F.lit(plain))
    return c


def read_diff(spark: SparkSession, path: str) -> DataFrame:
    """Read a written difference report back."""
    return read_csv(spark, path, DIFF_SCHEMA)


def read_source(spark: SparkSession, source_format: str, options: dict[str, str], query: str) -> DataFrame:
    """Run a query through any installed Spark connector."""
    return spark.read.format(source_format).options(**options).option("query", query).load()
