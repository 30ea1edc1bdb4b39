"""What the operators share: table access, the shared folder, staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    A cluster names it in spark.checkpoint.dir and has to. Only in local mode, as in
    tests, where all run in one process, a temporary folder may take its place.
    """
    name = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not name:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        current = context._jsc.sc().getCheckpointDir()
        if current.isEmpty():
            context.setCheckpointDir(tempfile.mkdtemp(prefix="shared-"))
            current = context._jsc.sc().getCheckpointDir()
        name = current.get()
    return name.rstrip("/")


def staging(spark: SparkSession) -> str:
    """The folder of this application, which clear_staged deletes."""
    return f"{shared_dir(spark)}/staged-{spark.sparkContext.applicationId}"


def clear_staged(spark: SparkSession) -> None:
    """Delete what this application has staged; to be called when its results are written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staging(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, label: str, compression: str = "none") -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back.

    Cuts the lineage: what was written survives the loss of any executor. Results are
    lazy, so the tables stay until clear_staged. Narrow tables hold hashes, which no codec
    makes smaller, and codecs hold memory outside the heap; tables of texts should name one.
    """
    path = f"{staging(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Groups that may count as large: at most HOT of them can hold more than one row in HOT of all rows.
HOT, SPREAD = 4096, 1 << 20


def with_group(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, least: int = 64, total: int | None = None) -> DataFrame:
    """rows joined to the columns of their group, null where it has none; groups is a staged
    table, one row a key, `size` the rows it has.

    Keys of large groups have a bounded broadcast (HOT rows). Their rows are answered by it
    and spread over the join with the other groups, where nothing fits them: no key is hot.
    total: the sum of the sizes, where it is known.
    """
    if total is None:
        total = groups.agg(F.sum(size)).first()[0] or 0
    large = F.col(size) >= max(least, total // HOT)
    more = [c for c in groups.columns if c not in keys]
    hot = groups.where(large).select(*keys, F.struct(*more).alias("__hot"))
    cold = groups.where(~large).select(*keys, F.lit(0).alias("__salt"), F.struct(*more).alias("__cold"))
    marked = rows.join(F.broadcast(hot), keys, "left")
    #: Null keys fit no group, so they are spread too.
    meets = F.col("__hot").isNull()
    for k in keys:
        meets &= F.col(k).isNotNull()
    salt = F.when(meets, F.lit(0)).otherwise(F.lit(1) + F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("int"))
    met = marked.withColumn("__salt", salt).join(cold, [*keys, "__salt"], "left")
    return met.select(*rows.columns, *(F.coalesce(f"__hot.{c}", f"__cold.{c}").alias(c) for c in more))
