"""Histograms, ratios, rankings and roll-ups. Each is one pre-aggregated shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions.paths import path_prefixes


def histogram(df: DataFrame, key: Column, missing: str | None = None, name: str = "key") -> DataFrame:
    key = F.coalesce(key, F.lit(missing)) if missing is not None else key
    return df.groupBy(key.alias(name)).agg(F.count("*").alias("n"))


def domain_histogram(df: DataFrame, key: Column, domain: list[str], other: str) -> DataFrame:
    """Every value of a fixed domain, zeros too; what is not in it counts as other."""
    found = histogram(df, F.when(key.isin(*domain), key).otherwise(F.lit(other)))
    #: The domain is a fixed list of the caller.
    names = df.sparkSession.createDataFrame([(d,) for d in dict.fromkeys([*domain, other])], "key string")
    return names.join(found, "key", "left").select("key", F.coalesce("n", F.lit(0)).alias("n"))


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def top(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_per(df: DataFrame, key: str, k: int, order: list[Column]) -> DataFrame:
    """The rank limit cuts each partition to k rows a key before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= k)


def shares(df: DataFrame, key: str) -> DataFrame:
    """Counts and their share of all rows; the total is one row, joined to one row a key."""
    found = df.groupBy(key).agg(F.count("*").alias("n"))
    return found.crossJoin(F.broadcast(found.agg(F.sum("n").alias("total")))).select(key, "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


def prefix_rollup(df: DataFrame, path: Column, least: int = 2) -> DataFrame:
    """Every path prefix with at least so many members: prefix, level, n."""
    rows = df.select(F.explode(path_prefixes(path)).alias("prefix"))
    return rows.groupBy("prefix").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("prefix", F.size(F.split("prefix", "/")).alias("level"), "n")


def pivot_counts(df: DataFrame, key: str, kind: str, kinds: list[str]) -> DataFrame:
    """One column of counts a kind, from one aggregation without a pivot's extra pass."""
    return df.groupBy(key).agg(*(F.count_if(F.col(kind) == k).alias(f"n_{k}") for k in kinds))


def mean_or_zero(values: Column) -> Column:
    return F.coalesce(F.avg(F.coalesce(values, F.lit(0.0))), F.lit(0.0))


def argmax(key: str, weight: Column) -> Column:
    """The key of the most weight, the first by name on a tie."""
    return F.min_by(key, F.struct(-weight, F.col(key)))


def statistics(df: DataFrame) -> DataFrame:
    """Measures of a files table in one pass."""
    return df.agg(
        F.count("*").alias("n_files"),
        F.sum("size_bytes").alias("total_size"),
        F.countDistinct("language").alias("n_languages"),
        F.countDistinct("source_location").alias("n_locations"),
        F.count_if(F.size("framework_hints") > 0).alias("n_hinted"),
        F.count_if(F.col("layer") == "Other").alias("n_other"),
        F.round(F.sum(F.when(F.col("size_bytes") > 0, F.col("size_bytes"))) / F.count("*"), 2).alias("average_size"),
    )
