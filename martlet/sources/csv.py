"""CSV in (raw layer) and CSV out (dashboard extracts).

Reading follows the raw-load rules: header row, quoted fields may contain
line breaks (``multiLine``), the quote and its escape are both ``"``.
``multiLine`` makes every file one unsplittable task, so large sources
should arrive as many files (or be converted to Parquet once, which is what
``load_raw_layer`` does when given ``out``).

A load either fails on a malformed row (the default) or sets it aside
(``quarantine``): rows that the parser cannot fit to the schema and rows
with a value that staging cannot type are stored beside the table's good
rows, each with its file, its text and the reasons. Both come from one pass
over the files, and the counts of every file are observed on the way.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.stack import union_all
from ..plans.staging import RULES, raw_name
from . import versions
from .schemas import RAW_FILES, RAW_SCHEMAS

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"',
               # the header must name the schema's columns in its order
               "enforceSchema": "false"}


#: Free text with line breaks; each of their files is one task, the others are split.
MULTILINE_TABLES = ("order_reviews",)


def read_csv(spark: SparkSession, path: str, schema: StructType, multiline: bool = True,
             lenient: bool = False) -> DataFrame:
    """One source CSV (file, folder or glob) with an explicit schema. A
    malformed row fails the load; with ``lenient`` its bad values are NULL."""
    opts = dict(CSV_OPTIONS, multiLine=str(multiline).lower(), mode="PERMISSIVE" if lenient else "FAILFAST")
    return spark.read.options(**opts).schema(schema).csv(path)


def read_source(spark: SparkSession, folder: str, table: str,
                files: dict[str, str] | None = None, multiline: bool | None = None,
                lenient: bool = False) -> DataFrame:
    """``multiline`` by default only for the tables whose text holds line breaks."""
    name = (files or RAW_FILES)[table]
    multiline = table in MULTILINE_TABLES if multiline is None else multiline
    return read_csv(spark, f"{folder.rstrip('/')}/{name}", RAW_SCHEMAS[table], multiline, lenient)


#: Columns that a quarantined load adds to a raw table's.
FILE, RECORD, REASONS, REJECTED = "_file", "_record", "_reasons", "_rejected"


def _typing_rules(table: str):
    """The staging rules that type a column of this raw table."""
    return [r for t, rules in RULES.items() if raw_name(t) == table for r in rules if r.kind]


def read_marked(spark: SparkSession, folder: str, table: str, files: dict[str, str] | None = None,
                multiline: bool | None = None) -> DataFrame:
    """Every row of a source table, malformed ones too, with the file it came
    from, its text where the parser could not fit it to the schema, and the
    reasons to set it aside (none for a good row). A header that does not
    name the schema's columns in order still fails: that is a wrong file."""
    multiline = table in MULTILINE_TABLES if multiline is None else multiline
    schema = StructType([*RAW_SCHEMAS[table].fields, StructField(RECORD, StringType())])
    opts = dict(CSV_OPTIONS, multiLine=str(multiline).lower(), mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD)
    df = spark.read.options(**opts).schema(schema).csv(f"{folder.rstrip('/')}/{(files or RAW_FILES)[table]}")
    reasons = [F.when(F.col(RECORD).isNotNull(), F.lit("malformed row"))]
    for r in _typing_rules(table):
        typed = F.expr(r.sql(lenient=True).rsplit(" AS ", 1)[0])
        reasons.append(F.when(F.col(RECORD).isNull() & F.col(r.source).isNotNull() & typed.isNull(), F.lit(f"no {r.kind}: {r.source}")))
    return (df.withColumn(FILE, F.col("_metadata.file_path"))
            .withColumn(REASONS, F.filter(F.array(*reasons), lambda x: x.isNotNull()))
            .withColumn(REJECTED, F.size(REASONS) > 0))


def store_raw(df: DataFrame, out: str, table: str) -> DataFrame:
    """The next version of a raw table; ``df`` may be marked (``read_marked``),
    then good rows and rejects go to a folder each in the same pass.
    Returns the good rows."""
    path = f"{out.rstrip('/')}/raw/{table}"
    if REJECTED not in df.columns:
        return versions.replace(df, path)

    def write(rows: DataFrame, folder: str) -> None:
        rows.write.partitionBy(REJECTED).parquet(folder)

    return good_rows(versions.replace(df, path, {"rejected": F.count_if(REJECTED)}, write=write), table)


def good_rows(stored: DataFrame, table: str) -> DataFrame:
    return stored.where(~F.col(REJECTED)).select(*RAW_SCHEMAS[table].names)


def stored_raw(spark: SparkSession, out: str, table: str) -> DataFrame:
    """A raw table's current version, its good rows where it was loaded with ``quarantine``."""
    df = versions.read(spark, f"{out.rstrip('/')}/raw/{table}")
    return good_rows(df, table) if REJECTED in df.columns else df


def loaded_rows(spark: SparkSession, out: str, names=None) -> dict[str, int]:
    """Rows of each raw table's current version, rejects not counted, as observed while it was loaded."""
    found = {t: versions.current(spark, f"{out.rstrip('/')}/raw/{t}") for t in names or RAW_SCHEMAS}
    return {t: v.metrics["rows"] - v.metrics.get("rejected", 0) for t, v in found.items() if v is not None and "rows" in v.metrics}


def rejects(spark: SparkSession, out: str, table: str) -> DataFrame:
    """(table_name, file, reasons, record) of the rows set aside when the
    table's current version was loaded; record is the text of a row that did
    not parse, else its values as JSON."""
    df = versions.read(spark, f"{out.rstrip('/')}/raw/{table}")
    if REJECTED not in df.columns:
        return spark.createDataFrame([], "table_name string, file string, reasons array<string>, record string")
    row = F.to_json(F.struct(*RAW_SCHEMAS[table].names))
    return df.where(REJECTED).select(F.lit(table).alias("table_name"), F.col(FILE).alias("file"), F.col(REASONS).alias("reasons"),
                                     F.coalesce(RECORD, row).alias("record"))


def load_report(spark: SparkSession, out: str, tables=None) -> DataFrame:
    """(table_name, file, reason, rows) of a quarantined load: for each file
    the good rows (reason NULL) and the rejects by reason; a row with two
    reasons counts under both, ``rejected_rows`` counts it once."""
    frames = []
    for t in tables or RAW_SCHEMAS:
        df = versions.read(spark, f"{out.rstrip('/')}/raw/{t}")
        if REJECTED not in df.columns:
            continue
        # one row for each file and set of reasons leaves the tasks
        per = df.groupBy(FILE, REASONS).agg(F.count(F.lit(1)).alias("n"))
        frames.append(per.select(F.lit(t).alias("table_name"), F.col(FILE).alias("file"), F.explode_outer(REASONS).alias("reason"), "n")
                      .groupBy("table_name", "file", "reason").agg(F.sum("n").alias("rows")))
    return union_all(frames) if frames else spark.createDataFrame([], "table_name string, file string, reason string, rows bigint")


def load_raw_layer(spark: SparkSession, folder: str, files: dict[str, str] | None = None,
                   out: str | None = None, tables=None, lenient: bool = False, quarantine: bool = False) -> dict[str, DataFrame]:
    """Load the source CSVs unmodified. With ``out``, each is written once as
    Parquet, the next version of ``out/raw/<table>``, and read back from
    there, so later layers scan columnar files instead of re-parsing CSV;
    the nine loads run concurrently. A malformed row fails the load; with
    ``quarantine`` it is set aside (see ``rejects``, ``load_report``), with
    ``lenient`` its bad values are NULL."""
    names = list(tables or RAW_SCHEMAS)
    if quarantine:
        frames = {t: read_marked(spark, folder, t, files) for t in names}
    else:
        frames = {t: read_source(spark, folder, t, files, lenient=lenient) for t in names}
    if not out:
        return {t: good_rows(df, t) for t, df in frames.items()} if quarantine else frames

    # a multi-line CSV file is read by one task; the loads are submitted
    # together so the files are parsed side by side, not one after another
    with ThreadPoolExecutor(max_workers=max(1, len(names))) as pool:
        futures = {t: pool.submit(store_raw, frames[t], out, t) for t in names}
        return {t: f.result() for t, f in futures.items()}


def write_extract_csv(df: DataFrame, path: str) -> None:
    """Export a result set as CSV with a header (full replace). Quoting
    mirrors the reader, so an export reads back to the same rows."""
    (df.write.mode("overwrite").option("header", "true").option("quote", '"')
     .option("escape", '"')
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     # full microsecond precision; the defaults drop the last three digits
     .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
     .csv(path))


def read_extract_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    # NULL is an unquoted empty field, the empty string a quoted one: no text may stand for NULL
    return (spark.read.options(**CSV_OPTIONS, mode="FAILFAST", nullValue="\u0001").schema(schema).csv(path))


def load_defects(df: DataFrame, expected_rows, required: list[str]) -> DataFrame:
    """Signs of a broken load: more rows than the source documents and NULLs
    in columns the source system always fills. One row per required column:
    (column_name, rows, expected_rows, excess_rows, nulls)."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(required)]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{c}', n_{i}" for i, c in enumerate(required))
    exp = (expected_rows if isinstance(expected_rows, Column) else F.lit(expected_rows)).cast("bigint")
    return one.select(
        "rows", F.expr(f"stack({len(required)}, {stack}) as (column_name, nulls)")
    ).select("column_name", "rows", exp.alias("expected_rows"),
             (F.col("rows") - exp).alias("excess_rows"), "nulls")


def multiline_difference(spark: SparkSession, path: str, schema: StructType,
                         required: list[str]) -> DataFrame:
    """Read a file with and without multi-line parsing and report both,
    the way a split-on-newline load was detected: (parse, rows, nulls)."""
    def summary(flag: bool) -> DataFrame:
        df = read_csv(spark, path, schema, multiline=flag, lenient=True)
        nulls = sum((F.col(c).isNull().cast("int") for c in required), F.lit(0))
        return df.agg(F.count(F.lit(1)).alias("rows"),
                      F.count_if(nulls > 0).alias("rows_with_required_nulls")) \
                 .select(F.lit("multiline" if flag else "single_line").alias("parse"), "*")
    return summary(True).unionByName(summary(False))
