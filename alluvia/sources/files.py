"""Batch file readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_OPTIONS = {"header": "true", "escape": '"', "multiLine": "false"}


def read_table(spark: SparkSession, location: str, evolve: bool = False) -> DataFrame:
    """A parquet directory; ``evolve`` merges the schemas of its files."""
    return spark.read.option("mergeSchema", str(evolve).lower()).parquet(location)


def _typed(text: Column, wanted: T.DataType) -> Column:
    """Cast CSV text leniently. Whole numbers written as ``3.0`` are still whole numbers."""
    direct = text.try_cast(wanted)
    if isinstance(wanted, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        number = text.try_cast("double")
        return F.coalesce(direct, F.when(number == F.floor(number), number.try_cast(wanted)))
    return direct


def read_csv_strict(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header, matched to the schema by column *name*.

    Spark applies a CSV schema by position; here a shuffled header still loads right and a missing
    column is an error instead of silently shifted data.
    """
    raw = (
        spark.read.options(**CSV_OPTIONS)
        .option("multiLine", str(multi_line).lower())
        .option("inferSchema", "false")
        .csv(path)
    )
    present = {name.lower(): name for name in raw.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in present]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}; its header is {raw.columns}")
    return raw.select(
        [_typed(F.col(f"`{present[f.name.lower()]}`"), f.dataType).alias(f.name) for f in schema.fields]
    )


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Whole-file JSON documents, one row per file (or per element of a top-level array)."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def read_lines(spark: SparkSession, path: str, comment: str | None = "#", unique: bool = False) -> DataFrame:
    """Trimmed non-blank lines as column ``value``, without comment lines."""
    lines = spark.read.text(path).select(F.btrim("value", F.lit(" \t\r\n\f\x0b")).alias("value"))
    lines = lines.filter(F.col("value") != "")
    if comment:
        lines = lines.filter(~F.col("value").startswith(comment))
    return lines.distinct() if unique else lines
