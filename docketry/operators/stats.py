"""Statistics over the file store and over ingest runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MB = 1024 * 1024


def size_mb(total: Column) -> Column:
    return total / F.lit(float(_MB))


def container_stats(listing: DataFrame) -> DataFrame:
    """File count and size."""
    total = F.coalesce(F.sum("size_bytes"), F.lit(0))
    return listing.agg(
        F.count(F.lit(1)).alias("total_files"),
        total.alias("total_size_bytes"),
        F.round(size_mb(total), 2).alias("total_size_mb"),
    )


def container_types(listing: DataFrame) -> DataFrame:
    """Files per text after the last dot, in its own case; ``unknown`` without a dot."""
    name = F.col("file_name")
    kind = F.when(name.contains("."), F.substring_index(name, ".", -1)).otherwise("unknown")
    return listing.groupBy(kind.alias("file_type")).agg(F.count(F.lit(1)).alias("n_files"))


def discover_by_type(listing: DataFrame) -> DataFrame:
    """Files per lower-cased extension; files without one are left out."""
    ext = F.lower(F.regexp_extract("file_name", r"[^/.][^/]*(\.[^/.]*)\z", 1))
    return (
        listing.select(ext.alias("file_type"))
        .where("file_type != ''")
        .groupBy("file_type")
        .agg(F.count(F.lit(1)).alias("n_files"))
    )


def with_ingested(listing: DataFrame, state: DataFrame) -> DataFrame:
    """The listing with its flag; a file the ledger does not know is not ingested."""
    return listing.join(
        state.select("file_name", "ingested"), "file_name", "left"
    ).withColumn("ingested", F.coalesce("ingested", F.lit(False)))


def discover_detailed(listing: DataFrame, state: DataFrame) -> DataFrame:
    """One row per file with size in MB and its ingested flag."""
    return with_ingested(listing, state).select(
        "file_name",
        F.coalesce("size_bytes", F.lit(0)).alias("size_bytes"),
        size_mb(F.coalesce("size_bytes", F.lit(0))).alias("size_mb"),
        "last_modified",
        "ingested",
    )


def discover(listing: DataFrame, state: DataFrame) -> DataFrame:
    """Totals, ingestion rate, latest and oldest file, in one pass."""
    flagged = with_ingested(listing, state)
    n, done = F.count(F.lit(1)), F.count_if(F.col("ingested"))
    total = F.coalesce(F.sum("size_bytes"), F.lit(0))
    by_time = F.when(F.col("last_modified").isNotNull(), F.struct("last_modified", "file_name"))
    return flagged.agg(
        n.alias("total_files"),
        done.alias("ingested_files"),
        (n - done).alias("not_ingested_files"),
        total.alias("total_size_bytes"),
        F.round(size_mb(total), 2).alias("total_size_mb"),
        F.max(by_time)["file_name"].alias("latest_file"),
        F.min(by_time)["file_name"].alias("oldest_file"),
        F.coalesce(F.round(F.try_divide(done * 100.0, n), 2), F.lit(0.0)).alias("ingestion_rate"),
    )


def run_stats(runs: DataFrame) -> DataFrame:
    """Counts of runs, time of the last finished one, message of the last failed one."""
    failed = F.col("status") == "error"
    n, bad = F.count(F.lit(1)), F.count_if(failed)
    last = F.max(F.when(failed, F.struct("completed_at", "run_id", "error")))
    return runs.agg(
        n.alias("total_ingestions"),
        (n - bad).alias("successful_ingestions"),
        bad.alias("failed_ingestions"),
        F.max(F.when(~failed, F.col("completed_at"))).alias("last_ingestion"),
        last["error"].alias("last_error"),
    )


def metrics(runs: DataFrame, listing: DataFrame, state: DataFrame) -> DataFrame:
    """Success rate of runs and average file size, 0 when there is nothing to divide."""
    service = run_stats(runs).select(
        "total_ingestions",
        "failed_ingestions",
        F.coalesce(
            F.try_divide(F.col("successful_ingestions") * 100.0, F.col("total_ingestions")),
            F.lit(0.0),
        ).alias("success_rate"),
    )
    found = discover(listing, state)
    average = F.round(F.try_divide(size_mb(F.col("total_size_bytes")), F.col("total_files")), 2)
    return found.select(
        *[service.select(c).scalar().alias(c) for c in service.columns],
        "total_files",
        "ingestion_rate",
        "total_size_mb",
        F.coalesce(average, F.lit(0.0)).alias("average_file_size_mb"),
    )
