"""Quality gates as rows: gate, value, threshold, ok."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The least (or most, where said) that each measure must reach.
THRESHOLDS = {"parse_success": 0.7, "route_resolution": 0.5, "unresolved": 0.2, "embedding_coverage": 0.8, "cohesion": 0.5, "config_parse": 0.8, "pattern_confidence": 0.8, "capability_coverage": 0.8, "citations": 1.0}
AT_MOST = {"unresolved"}


def gate_rows(measures: DataFrame) -> DataFrame:
    """measures: one row, a column a gate. One row a gate; a null measure fails."""
    rows = [F.struct(F.lit(n).alias("gate"), F.round(F.col(n).cast("double"), 6).alias("value"), F.lit(THRESHOLDS[n]).alias("threshold")) for n in measures.columns if n in THRESHOLDS]
    out = measures.select(F.explode(F.array(*rows)).alias("g")).select("g.*")
    ok = F.when(F.col("gate").isin(*AT_MOST), F.col("value") <= F.col("threshold")).otherwise(F.col("value") >= F.col("threshold"))
    return out.withColumn("ok", F.coalesce(ok, F.lit(False)))


def enforced(gates: DataFrame) -> None:
    """Raise where a gate fails; the rows are as many as there are gates."""
    if failed := [f"{r['gate']} {r['value']}" for r in gates.where("NOT ok").collect()]:
        raise ValueError("quality gates failed: " + ", ".join(sorted(failed)))


def ratio(part: Column, whole: Column, empty: float = 1.0) -> Column:
    return F.when(whole == 0, empty).otherwise(part / whole)


def count_mismatch(declared: DataFrame, counted: DataFrame, key: str) -> DataFrame:
    """Keys whose declared and recomputed counts differ, from either side."""
    d, c = declared.select(key, F.col("n").alias("declared")), counted.select(key, F.col("n").alias("counted"))
    return d.join(c, key, "full").where(F.coalesce("declared", F.lit(0)) != F.coalesce("counted", F.lit(0)))


def flagged(df: DataFrame, rules: dict[str, Column], id_col: str) -> DataFrame:
    """One row for each rule that a row breaks: id, issue."""
    issues = F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in rules.items())))
    return df.select(id_col, F.explode(issues).alias("issue"))


def layer_rules(files: DataFrame, expected: dict[str, list[str]], tolerance: float = 0.2) -> DataFrame:
    """By language: the share of files outside the layers expected, and whether it is tolerated."""
    outside = reduce(lambda a, b: a | b, ((F.col("language") == k) & ~F.col("layer").isin(*v) for k, v in expected.items()), F.lit(False))
    own = files.where(F.col("language").isin(*expected)).groupBy("language").agg(F.count("*").alias("n"), F.count_if(outside).alias("n_outside"))
    return own.withColumn("ok", F.col("n_outside") <= tolerance * F.col("n"))


def relation_audit(before: DataFrame, after: DataFrame) -> DataFrame:
    """What a filter took away, by type, most first."""
    gone = before.join(after.select("id"), "id", "left_anti")
    return gone.groupBy("type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "type")
