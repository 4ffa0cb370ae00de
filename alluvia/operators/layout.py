"""Table maintenance: file statistics, compaction and Z-order clustering."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEGABYTE = 1024 * 1024
TARGET_BYTES = 256 * MEGABYTE
TASK_BYTES = 192 * MEGABYTE  # rows that one task sorts, unpacked: Parquet may hold ten times as many in a file of the target size
MOST_BITS = 8  # fixed value: a rank is a CASE tree of up to 2**bits - 1 comparisons, which code generation must bear


class Listing(NamedTuple):
    files: int
    bytes: int


def listing(spark: SparkSession, location: str) -> Listing:
    """Data files of a table as Spark's file index lists them for a scan; no job runs and no file is opened."""
    try:
        rows = spark.read.schema("none int").option("pathGlobFilter", "*.parquet").parquet(location)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return Listing(0, 0)
    count = len(rows._jdf.inputFiles())
    return Listing(count, int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) if count else 0)


def table_stats(spark: SparkSession, location: str) -> DataFrame:
    """Number of data files and their size in bytes, MB and GB, from the listing."""
    files, size = (F.lit(n).cast("long") for n in listing(spark, location))
    return spark.range(1).select(
        files.alias("num_files"),
        size.alias("size_in_bytes"),
        F.round(size / MEGABYTE, 2).alias("size_in_mb"),
        F.round(size / (1024 * MEGABYTE), 2).alias("size_in_gb"),
    )


def file_sizes(spark: SparkSession, location: str) -> DataFrame:
    """``path, folder, bytes, rows`` of every data file, from its metadata and footer: no column is read. Paths are URIs."""
    files = spark.read.parquet(location).groupBy(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(F.count("*").alias("rows"))
    return files.select("path", F.regexp_replace("path", "/[^/]*$", "").alias("folder"), "bytes", "rows")


def small_files(files: DataFrame, target_bytes: int) -> DataFrame:
    """Files that are worth rewriting, with the ``bin`` they are packed into.

    Within a folder the files below the target are laid end to end and cut at its multiples; a bin of one file is left alone. Folders that
    hold very many files bound nothing else here: a window has one narrow row for each of them.
    """
    each = Window.partitionBy("folder")
    before = F.sum("bytes").over(each.orderBy("path")) - F.col("bytes")
    packed = files.filter(F.col("bytes") < target_bytes).withColumn("bin", F.floor(before / target_bytes))
    together = packed.withColumn("others", F.count("*").over(Window.partitionBy("folder", "bin")) - 1)
    return together.filter("others > 0").drop("others")


def compare_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row on what a rewrite saved; the reduction is NULL for an empty table."""
    both = before.withColumn("_when", F.lit("before")).unionByName(after.withColumn("_when", F.lit("after")))
    sides = both.agg(*[
        F.max(F.when(F.col("_when") == when, F.col(c))).alias(f"{when}_{c}")
        for when in ("before", "after") for c in before.columns
    ])
    saved = F.col("before_num_files") - F.col("after_num_files")
    return sides.withColumns({
        "files_saved": saved,
        "files_saved_pct": F.round(F.try_divide(saved * 100.0, F.col("before_num_files")), 2),
        "mb_saved": F.round(F.col("before_size_in_mb") - F.col("after_size_in_mb"), 2),
    })


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    target_bytes: int = TARGET_BYTES,
    partition_by: Sequence[str] = (),
) -> None:
    """Rewrite a table into files of about ``target_bytes``, row for row.

    Without partitions nothing is shuffled: the scan itself packs small files into splits of the target
    size (and cuts large files at row groups), and every split is written as one file. A partitioned table
    is rebalanced on its partition columns, which merges small and splits large partitions.
    """
    rows = packing_session(spark, target_bytes).read.parquet(source)
    if partition_by:
        rows.hint("rebalance", *partition_by).write.partitionBy(*partition_by).mode("overwrite").parquet(target)
    else:
        rows.write.mode("overwrite").parquet(target)


def packing_session(spark: SparkSession, target_bytes: int) -> SparkSession:
    """A session whose scans pack small files into splits of the target size; streams of the caller's session go on planning with its
    own settings."""
    own = spark.newSession()
    for name, value in {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.files.openCostInBytes": str(min(target_bytes // 64, 4 * MEGABYTE)),
        "spark.sql.files.minPartitionNum": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
    }.items():
        own.conf.set(name, value)
    return own


@dataclass(frozen=True)
class Cuts:
    """Ascending cut points of one column; a value's rank is the number of cuts at or below it."""

    column: str
    points: tuple

    def rank(self) -> Column:
        """Binary search as nested CASE expressions: log2(cuts) comparisons per row."""
        subject = F.col(self.column)

        def search(low: int, high: int) -> Column:
            if low == high:
                return F.lit(low)
            middle = (low + high) // 2
            return F.when(subject >= F.lit(self.points[middle]), search(middle + 1, high)).otherwise(
                search(low, middle)
            )

        return search(0, len(self.points)).cast("long")


def find_cuts(df: DataFrame, columns: Sequence[str], bits: int) -> list[Cuts]:
    """Equal-frequency cut points of whole columns: at most ``2**bits - 1`` values each come back from the cluster.

    Numbers, dates and times go through one aggregation of mergeable quantile sketches over all rows. Other ordered types are dealt
    into ``2**bits`` ranges, and the least value of each is a cut.
    """
    slots = 2**bits
    kinds = {f.name: f.dataType for f in df.schema.fields}
    sketched = [c for c in columns if isinstance(kinds[c], (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))]
    found: dict[str, list] = {}
    if sketched:
        shares = [i / slots for i in range(1, slots)]
        row = df.agg(*[F.percentile_approx(c, shares, 100 * slots).alias(c) for c in sketched]).first()
        found = {c: row[c] or [] for c in sketched}
    for c in columns:
        if c not in found:
            ranges = df.select(c).filter(F.col(c).isNotNull()).repartitionByRange(slots, c)
            starts = ranges.groupBy(F.spark_partition_id()).agg(F.min(c).alias(c)).collect()  # a row per range
            found[c] = sorted(r[c] for r in starts)[1:]
    return [Cuts(c, tuple(sorted(set(found[c])))) for c in columns]


def bits_for(files: int, columns: int) -> int:
    """Two bits finer than the grid that ``files`` boxes make; what is finer still is left to the sort inside a cell."""
    return min(MOST_BITS, 62 // columns, -(-(max(files, 2) - 1).bit_length() // columns) + 2)


def z_value(cuts: Sequence[Cuts], bits: int) -> Column:
    """Interleave the bits of the columns' ranks, the highest bit of the first column leading."""
    z = F.lit(0).cast("long")
    place = len(cuts) * bits - 1
    for bit in range(bits - 1, -1, -1):
        for cut in cuts:
            taken = F.shiftright(cut.rank(), bit).bitwiseAND(F.lit(1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(taken, place))
            place -= 1
    return z


def zorder(df: DataFrame, columns: Sequence[str], files: int, bits: int | None = None) -> DataFrame:
    """Rows arranged so that each of ``files`` tasks holds a compact box of the given columns.

    Inside a cell of the grid the rows are split by the columns. Rows that agree in all of them (a hot key, say) can still spread
    over several tasks: the range partitioning goes on by a hash of the whole row and by input partition, which also separates
    exact copies.
    """
    bits = bits_for(files, len(columns)) if bits is None else bits
    if len(columns) * bits > 62:
        raise ValueError("the interleaved value must fit a BIGINT")
    cuts = find_cuts(df, columns, bits)
    ranks = df.withColumns({f"_rank{i}": cut.rank() for i, cut in enumerate(cuts)})
    marked = ranks.withColumns({
        "_z": z_value([RankColumn(f"_rank{i}") for i in range(len(cuts))], bits),
        "_spread": F.xxhash64(*df.columns, F.spark_partition_id()),
    })
    return (
        marked.repartitionByRange(files, "_z", *columns, "_spread")
        .sortWithinPartitions("_z", *columns)
        .select(*df.columns)
    )


@dataclass(frozen=True)
class RankColumn:
    """A rank that is already a column."""

    column: str

    def rank(self) -> Column:
        return F.col(self.column)


def unpacked_bytes(rows: DataFrame) -> int:
    """What all rows take in memory, about: eight bytes a column, and texts, binaries and nested columns as long as they are."""
    def long(f: T.StructField) -> Column:
        plain = isinstance(f.dataType, (T.StringType, T.BinaryType))
        return F.coalesce(F.octet_length(F.col(f"`{f.name}`") if plain else F.to_json(F.struct(F.col(f"`{f.name}`")))).cast("long"), F.lit(0))

    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.NullType)
    sums = [F.coalesce(F.sum(long(f)), F.lit(0)) for f in rows.schema.fields if not isinstance(f.dataType, fixed)]
    row = rows.agg(F.count("*") * (8 * len(rows.columns)), *sums).first()
    return int(sum(row))


def files_for(
    spark: SparkSession, location: str, target_bytes: int = TARGET_BYTES, rows: DataFrame | None = None, task_bytes: int = TASK_BYTES
) -> int:
    """Files of about ``target_bytes``; of ``rows`` that are given, also so many that a task sorts no more than about ``task_bytes`` of them."""
    files = -(-listing(spark, location).bytes // target_bytes)
    if rows is not None:
        files = max(files, -(-unpacked_bytes(rows) // task_bytes))
    return max(1, files)


def clusterable(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of the columns that exist and have an order."""
    ordered = {f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))}
    return [c for c in columns if c in ordered]
