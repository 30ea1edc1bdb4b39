"""Stage outputs: Parquet tables that later stages, or a partial run, read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def write_table(df: DataFrame, root: str, stage: str, name: str) -> DataFrame:
    """Replace the table; read back, so that what follows starts from the files."""
    path = f"{root}/{stage}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def read_table(spark: SparkSession, root: str, stage: str, name: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{root}/{stage}/{name}")
    except AnalysisException:
        return None


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def as_json(df: DataFrame, *drop: str) -> DataFrame:
    return df.select(F.to_json(F.struct(*(c for c in df.columns if c not in drop))).alias("value"))


def write_text(df: DataFrame, path: str, column: str = "markdown") -> None:
    df.select(column).write.mode("overwrite").text(path)


def append_cache(vectors: DataFrame, root: str, model: str, d: int) -> None:
    vectors.write.mode("append").parquet(f"{root}/vectors/model={model}/dim={d}")
