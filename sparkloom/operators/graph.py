"""Edge lists: closure, propagation, traces, coverage, evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.text import hash_fraction
from sparkloom.sources.shared import checkpoint_dir


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def closure(edges: DataFrame) -> DataFrame:
    """edges: a, b. Pairs (a, b, depth) with the least depth, semi-naive: only new pairs join again, until there are none."""
    known = new = checkpointed(edges.where("a != b").select("a", "b").distinct().withColumn("depth", F.lit(1)))
    depth = 1
    while True:
        depth += 1
        step = new.select("a", F.col("b").alias("via")).join(edges.select(F.col("a").alias("via"), "b"), "via").where("a != b").select("a", "b").distinct()
        new = checkpointed(step.join(known, ["a", "b"], "left_anti").withColumn("depth", F.lit(depth)))
        if new.isEmpty():
            return known
        #: The parts stay as they were written; nothing is written twice.
        known = known.unionByName(new)


def propagated(owners: DataFrame, reach: DataFrame) -> DataFrame:
    """owners: node, role. Roles of all that a node reaches: a, role."""
    return reach.select("a", F.col("b").alias("node")).join(owners, "node").select("a", "role").distinct()


def chain(start: DataFrame, edges: DataFrame, budget: int = 5) -> DataFrame:
    """Breadth first from each start, by order of edge type and id, until budget nodes are taken.

    Each level is one join; a start keeps at most budget nodes, so no group grows.
    """
    from pyspark.sql import Window

    taken = start.select("start", F.col("start").alias("node"), F.lit(0).alias("level"), F.lit("").alias("way"))
    last = taken
    for level in range(1, budget):
        step = last.select("start", F.col("node").alias("from_id"), "way").join(edges, "from_id").select("start", F.col("to_id").alias("node"), F.concat_ws("/", "way", F.col("rank").cast("string"), "to_id").alias("way"))
        step = step.join(taken.select("start", "node"), ["start", "node"], "left_anti").groupBy("start", "node").agg(F.min("way").alias("way")).withColumn("level", F.lit(level))
        last = checkpointed(step)
        taken = taken.unionByName(last.select("start", "node", "level", "way"))
    return taken.withColumn("ord", F.row_number().over(Window.partitionBy("start").orderBy("level", "way"))).where(F.col("ord") <= budget)


def stubs(relations: DataFrame, entities: DataFrame) -> DataFrame:
    """Endpoints that no entity has: id, type (by the id's prefix)."""
    ends = relations.select(F.explode(F.array("from_id", "to_id")).alias("id")).distinct()
    return ends.join(entities.select("id"), "id", "left_anti").select("id", F.substring_index("id", "_", 1).alias("type"))


def sampled(evidence: DataFrame, key: str, rate: float) -> DataFrame:
    return evidence.where(hash_fraction(F.col(key)) < rate)


def gated(relations: DataFrame, least: float) -> DataFrame:
    return relations.where(F.coalesce("confidence", F.lit(0.0)) >= least)


def crud_summary(relations: DataFrame, key: str) -> DataFrame:
    """Sorted tables by kind of edge, as texts."""
    listed = lambda kind: F.array_join(F.array_sort(F.collect_set(F.when(F.col("type") == kind, F.col("to_id")))), ",")
    return relations.groupBy(key).agg(*(listed(k).alias(k) for k in ("readsFrom", "writesTo", "deletesFrom")))


def trace_confidence(has_screen: Column, has_tables: Column) -> Column:
    return F.when(has_screen & has_tables, 0.7).when(has_screen | has_tables, 0.65).otherwise(0.6)


def coverage(nodes: DataFrame, relations: DataFrame, kinds: list[str]) -> DataFrame:
    """By kind: distinct sources that have such an edge, and their share of the nodes."""
    total = nodes.agg(F.count("*").alias("total"))
    found = relations.where(F.col("type").isin(*kinds)).groupBy("type").agg(F.countDistinct("from_id").alias("covered"), F.count("*").alias("edges"))
    return found.crossJoin(F.broadcast(total)).select("type", "covered", "edges", F.round(F.col("covered") / F.col("total"), 6).alias("share"))


#: Parts of a name whose first minima are found side by side before those of the whole name.
PARTS = 64


def frontier(since: DataFrame, keys: list[str]) -> DataFrame:
    """since: keys, since, root. Of each name the rows with a lesser root than all before: where a group asks for the
    least root since a key, no other row can be the answer. Found by parts first, so that no name is one task's work."""
    from pyspark.sql import Window

    def kept(rows: DataFrame, *more: str) -> DataFrame:
        before = F.min("root").over(Window.partitionBy(*keys, *more).orderBy("since", "root").rowsBetween(Window.unboundedPreceding, -1))
        return rows.withColumn("__before", before).where("__before IS NULL OR root < __before").drop("__before", *more)

    return kept(kept(since.withColumn("__part", F.pmod(F.xxhash64("root"), F.lit(PARTS))), "__part"))


def group_roots(groups: DataFrame) -> DataFrame:
    """groups: key, single, tables, roles (arrays). key and root: the group that each ends up in.

    In order of key, a single route joins the first group that shares enough tables with it (half of its own, two at
    most) or any role; what joined before counts for the group. Each round all single routes propose at once, by an
    index of the groups' tables and roles with the first key that brought them: only what came before a key counts for
    it. A key is right once those before it are, so the rounds end, and where nothing changes the result is that of
    the fold in order. The rounds are as many as groups that depend on each other in a row.

    A single route asks each of its roles, and its tables (or, where two are needed, each pair of them), for the least
    root before its key; of each name and pair only the frontier answers, so a name that all groups share costs no
    row for each two of them."""
    need = F.least(F.lit(2), F.ceil(F.size("tables") / 2))
    part = lambda kind: F.transform(F.array_distinct(F.coalesce(F.col(f"{kind}s"), F.array().cast("array<string>"))), lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("name")))
    listed = F.concat(part("table"), part("role"))
    held = checkpointed(groups.select("key", "single", need.alias("need"), F.explode(listed).alias("r")).select("key", "single", "need", "r.kind", "r.name"))
    alone = held.where("single AND (kind = 'role' OR need < 2)").select("key", "kind", "name")
    two = held.where("single AND kind = 'table' AND need = 2").select("key", "name")
    pairs = checkpointed(two.join(two.withColumnRenamed("name", "other"), "key").where("name < other"))
    asked = pairs.select("name", "other").distinct()
    keys = groups.select("key")
    roots = checkpointed(keys.withColumn("root", F.col("key")))
    while True:
        since = checkpointed(held.join(roots, "key").groupBy("kind", "name", "root").agg(F.min("key").alias("since")))
        tables = since.where("kind = 'table'").select("name", "root", "since")
        both = tables.join(asked, "name").join(tables.select(F.col("name").alias("other"), "root", F.col("since").alias("then")), ["other", "root"]).select("name", "other", "root", F.greatest("since", "then").alias("since"))
        met = alone.join(frontier(since, ["kind", "name"]), ["kind", "name"]).where("since < key").select("key", "root")
        met = met.unionByName(pairs.join(frontier(both, ["name", "other"]), ["name", "other"]).where("since < key").select("key", "root"))
        first = met.groupBy("key").agg(F.min("root").alias("first"))
        new = checkpointed(keys.join(first, "key", "left").select("key", F.coalesce("first", "key").alias("root")))
        if new.join(roots, ["key", "root"], "left_anti").isEmpty():
            return new
        roots = new


def merged_groups(groups: DataFrame) -> DataFrame:
    """groups: key, routes, tables, roles (arrays). The merged groups, with the sorted names of all three as texts."""
    roots = group_roots(groups.select("key", (F.size("routes") == 1).alias("single"), "tables", "roles"))
    named = lambda c: F.concat_ws(",", F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))).alias(c)
    return groups.join(roots, "key").groupBy(F.col("root").alias("key")).agg(named("routes"), named("tables"), named("roles"))
