"""Readers for CSV and parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfcast.sources.schema import to_contract

BAD_RECORD = "_bad_record"

# Up to so many filled cells of a row their places are added up run by run.
FEW_CELLS = 64
MAX_TEXT = 2**31 - 1


def read_named(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


def read_contract(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """Parquet table checked against and cast to a contract."""
    return to_contract(spark.read.parquet(path), contract)


def read_csv_typed(
    spark: SparkSession, path: str, schema: T.StructType, on_bad_rows: str = "fail"
) -> DataFrame:
    """CSV with a header and a given schema, bound by name.

    ``fail`` stops the read at the first value that does not parse, because a silent
    null in the sales column would turn a broken row into a row to be predicted. It parses
    every column, whichever of them a query selects, so a broken value in a column that is
    not asked for stops the read too. Rows that a filter drops during the scan are parsed
    as far as the filter needs. ``mark`` keeps such rows and puts their text in ``_bad_record``.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if on_bad_rows == "fail":
        rows = reader.schema(schema).option("mode", "FAILFAST").csv(path)
        # true for every row, and it reads all columns
        return rows.where(F.hash(*(F.col(f"`{c}`") for c in rows.columns)) >= F.lit(-(2**31)))
    if on_bad_rows == "mark":
        marked = T.StructType(schema.fields + [T.StructField(BAD_RECORD, T.StringType())])
        return (
            reader.schema(marked)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", BAD_RECORD)
            .csv(path)
        )
    raise ValueError(f"on_bad_rows must be 'fail' or 'mark', not {on_bad_rows!r}")


def read_csv_strings(spark: SparkSession, path: str, packed: Sequence[str] = ()) -> DataFrame:
    """CSV with a header, every column a string: one pass, no inference.

    ``packed`` names the last columns of the file, which hold numbers and are mostly empty.
    They come as one column ``cells``, the cells with something in them as ``at``, the place
    of the column in ``packed``, and ``value``. The whole line is read, but an empty cell is
    one character of a run of commas, not a column; thousands of them take many times as
    long. A quote among them raises an error.
    """
    rows = spark.read.option("header", True).csv(path)
    if not packed:
        return rows
    names = rows.columns
    keys = names[: len(names) - len(packed)]
    if not keys or names[len(keys) :] != list(packed):
        raise ValueError("packed columns are the last ones of the file, behind others")
    lines = spark.read.text(path)
    header = lines.first()
    lines = lines.where((F.col("value") != header["value"]) & (F.col("value") != ""))
    field = r'(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^,"]*+)'
    keyed = lines.select("value", F.regexp_extract("value", f"^{field}(?:,{field}){{{len(keys) - 1}}}", 0).alias("_keyed"))
    rest = F.substr("value", F.length("_keyed") + 1, F.lit(MAX_TEXT))
    rest = F.when(F.contains(rest, F.lit('"')), F.raise_error(F.lit("a packed cell is quoted")).cast("string")).otherwise(rest)
    own = F.from_csv("_keyed", ", ".join(f"`{k}` string" for k in keys))
    # a comma stands before each cell: a run of them, and the cell after it
    runs = keyed.select(own.alias("_own"), F.regexp_extract_all(rest, F.lit(",+[^,]*"), F.lit(0)).alias("_runs"), rest.alias("_rest"))

    def cell(run):
        return F.substring_index(run, ",", -1)

    def found(run, i):
        before = F.aggregate(F.slice("_runs", 1, i), F.lit(0), lambda n, r: n + F.length(r) - F.length(cell(r)))
        return F.struct((before + F.length(run) - F.length(cell(run)) - 1).alias("at"), cell(run).alias("value"))

    def dense(value, i):
        return F.struct((i - 1).alias("at"), value.alias("value"))

    cells = F.when(F.size("_runs") <= FEW_CELLS, F.transform("_runs", found)).otherwise(
        F.transform(F.split("_rest", ","), dense)
    )
    return runs.select("_own.*", F.filter(cells, lambda e: e["value"] != "").alias("cells"))


def read_csv_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with a header and inferred types. Inference reads the file once more, so
    prefer ``read_csv_typed`` for large files."""
    return spark.read.csv(path, sep=sep, header=True, inferSchema=True)


def even_numbers(spark: SparkSession, start: int, end: int) -> DataFrame:
    """The even numbers of start..end-1 as column ``n``."""
    return spark.range(start, end).where(F.col("id") % 2 == 0).select(F.col("id").alias("n"))
