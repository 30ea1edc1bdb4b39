"""Role edges: from annotations, markup and code, with their confidence and best evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.text import canonical_role, role_category, split_roles

#: Confidence by where a role was found.
CONFIDENCE = {"class": 0.9, "method": 0.95, "page": 0.9, "markup": 0.92, "code": 0.86}
#: Evidence of the first kind there is counts.
PRIORITY = ("tag", "guard", "helper", "text")


def role_edges(found: DataFrame) -> DataFrame:
    """found: source_id, place, role (one or several in a text). Edges to canonical roles, each once."""
    rows = found.select("source_id", "place", F.explode(split_roles(F.col("role"))).alias("r")).withColumn("r", canonical_role(F.col("r"))).where("r IS NOT NULL AND r != ''")
    confidence = F.coalesce(*(F.when(F.col("place") == k, F.lit(v)) for k, v in CONFIDENCE.items()), F.lit(0.86))
    return rows.groupBy(F.col("source_id").alias("from_id"), F.concat(F.lit("role_"), "r").alias("to_id")).agg(F.max(confidence).alias("confidence")).withColumn("type", F.lit("securedBy"))


def best_evidence(spans: DataFrame) -> DataFrame:
    """spans: from_id, to_id, kind, line, end_line. The span of the first kind, then the first line."""
    rank = F.coalesce(*(F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(PRIORITY)), F.lit(len(PRIORITY)))
    return spans.groupBy("from_id", "to_id").agg(F.min(F.struct(rank.alias("rank"), "line", "end_line", "kind")).alias("s")).select("from_id", "to_id", "s.kind", "s.line", "s.end_line")


def summary(edges: DataFrame, examples: int = 10) -> DataFrame:
    """Roles with their category, how many sources they secure, and a few of them by name."""
    own = edges.where("type = 'securedBy'").groupBy("to_id").agg(F.countDistinct("from_id").alias("n"), F.min("from_id").alias("example"))
    return own.select(F.regexp_replace("to_id", "^role_", "").alias("role"), "n", "example").withColumn("category", role_category(F.col("role"))).orderBy(F.desc("n"), "role").limit(examples)
