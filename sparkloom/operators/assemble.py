"""Capabilities: groups of routes with their tables, roles and citations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.paths import business_domain
from sparkloom.functions.scoring import capability_confidence
from sparkloom.functions.text import humanize
from sparkloom.operators.graph import checkpointed, group_roots


def capabilities(routes: DataFrame, relations: DataFrame, merge: bool = False) -> DataFrame:
    """routes: id, path. relations: from_id, to_id, type, confidence. One row a business domain; with merge, domains of
    a single route join the first that shares tables or roles with them."""
    own = routes.select("id", "path", business_domain(F.col("path")).alias("domain"))
    edges = relations.select(F.col("from_id").alias("id"), "to_id", "type")
    joined = own.join(edges, "id", "left")
    tables = F.array_sort(F.collect_set(F.when(F.col("type").isin("readsFrom", "writesTo", "deletesFrom"), F.regexp_replace("to_id", "^table_", ""))))
    roles = F.array_sort(F.collect_set(F.when(F.col("type") == "securedBy", F.col("to_id"))))
    if merge:
        groups = checkpointed(joined.groupBy(F.col("domain").alias("key")).agg((F.countDistinct("id") == 1).alias("single"), tables.alias("tables"), roles.alias("roles")))
        joined = joined.join(group_roots(groups).withColumnRenamed("key", "domain"), "domain").drop("domain").withColumnRenamed("root", "domain")
    screens = F.array_sort(F.collect_set(F.when(F.col("type") == "renders", F.col("to_id"))))
    handlers = F.array_sort(F.collect_set(F.when(F.col("type") == "handlesRoute", F.col("to_id"))))
    sets = joined.groupBy("domain").agg(F.countDistinct("id").alias("members"), tables.alias("tables"), roles.alias("roles"), screens.alias("screens"), handlers.alias("handlers"), F.count("to_id").alias("citations"))
    return sets.select(F.concat(F.lit("cap_domain_"), "domain").alias("id"), humanize(F.col("domain")).alias("name"), "domain", "members", "tables", "roles", "screens", "handlers", "citations", capability_confidence(F.col("members"), F.lit(False)).alias("confidence"))


def summary(caps: DataFrame, k: int = 5) -> DataFrame:
    return caps.orderBy(F.desc("citations"), F.desc("confidence"), "id").limit(k)


def usage(relations: DataFrame) -> DataFrame:
    """Reads, writes and deletes by table, from one aggregation."""
    return relations.groupBy(F.regexp_replace("to_id", "^table_", "").alias("table_name")).agg(*(F.count_if(F.col("type") == t).alias(n) for t, n in (("readsFrom", "reads"), ("writesTo", "writes"), ("deletesFrom", "deletes"))))


def coverage_share(caps: DataFrame, routes: DataFrame) -> DataFrame:
    """Distinct routes covered, by all routes."""
    return caps.agg(F.sum("members").alias("covered")).crossJoin(F.broadcast(routes.agg(F.countDistinct("id").alias("routes")))).select("covered", "routes", F.round(F.col("covered") / F.col("routes"), 6).alias("share"))
