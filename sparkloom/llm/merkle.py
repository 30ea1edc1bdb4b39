"""Merkle manifest of a dataset: RDD supersteps up and down a tree of hashes.

Each row is a leaf, the hash of its columns. The leaves of a group ascend by id; every
three consecutive nodes make a parent until one is left, the subroot. The subroots,
ordered by group, are the leaves of one more tree, whose last node is the root.

Going up, a vertex sends its digest to its parent; a parent whose children are complete
(three, or fewer where one of them is marked as the last of its level) hashes and
forwards. A vertex is known by its group's number and its place in the level, so parents
are found by division and nobody needs the size of a group. Vertices are dealt out in
blocks of 3**SPAN neighbours: messages within a block are delivered in place, those
between blocks in the shuffle that ends the superstep, so a tree of n leaves takes
log3(n) / SPAN supersteps. Going down, each block gets the path from the root to its top
node, adds the siblings within, and passes it on; leaves end up with whole proofs.

Numbers of groups and places come from one sort by (group, id, leaf) and one line a
partition (its first and last group, and counts), which alone goes to the driver. No
group is ever in one task: a block has at most 3**SPAN messages. The blocks of every
superstep are checkpointed in the shared folder.

A proof is an array of strings, leaf level first: the node's place in its run (0 to 2),
then the digests of the others in the run, 64 letters each. `folded` recomputes the root
from a leaf and its proof within the row.

Defined results: null values count as `-`. Null ids come first in their group, rows of
one id in the order of their leaves, repeated rows are leaves of their own; null groups
form the first group. A lone leaf is its group's subroot, a lone subroot the root. An
empty table gives an empty result. Columns that are not named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from sparkloom.llm.common import shared_dir, staged, table

ARITY, SPAN = 3, 4
BLOCK = ARITY**SPAN
#: Messages for which the next superstep has one more partition.
SHARE = 4096
DIGEST = 64
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def part(value: Column) -> Column:
    """A value as its UTF-8 byte count and itself; null is `-`."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Sequence[str] = COLUMNS, instead: dict[str, Column] | None = None) -> Column:
    """The hash of a row; `instead` has other values for some columns."""
    values = [(instead or {}).get(c, F.col(f"`{c}`")) for c in columns]
    return F.sha2(F.concat(*map(part, values)), 256)


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""

    def step(digest: Column, run: Column) -> Column:
        before = F.substring(run, F.lit(1), F.lit(1)).cast("int") * DIGEST
        return F.sha2(F.concat(F.substring(run, F.lit(2), before), digest, F.substring(run, before + 2, F.lit(ARITY * DIGEST))), 256)

    return F.aggregate(proof, start, step)


def siblings(proof: Column) -> Column:
    """The digests of a proof, joined."""
    return F.array_join(F.transform(proof, lambda run: F.substring(run, F.lit(2), F.lit(ARITY * DIGEST))), "")


def hashed(digests: Iterable[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def levels_of(digests: list[str], whole: bool) -> list[list[str]]:
    """The levels within a block, from its children to its top; a block that holds the whole level ends at its root."""
    levels = [digests]
    while len(levels) <= SPAN and not (whole and len(levels[-1]) == 1):
        below = levels[-1]
        levels.append([hashed(below[k : k + ARITY]) for k in range(0, len(below), ARITY)])
    return levels


def completed(block) -> tuple:
    """(number of the block, its messages in order, whether it holds the whole level)."""
    (group, number), messages = block
    messages = sorted(messages, key=lambda m: m[0])
    last = messages[-1][2]
    if [m[0] for m in messages] != list(range(len(messages))) or not last and len(messages) != BLOCK:
        raise ValueError(f"block {number} of group {group} misses messages")
    return (group, number), messages, number == 0 and last


def sent_up(block) -> tuple:
    """(key, digest of the top node, last of its level, whether it is the root)."""
    key, messages, whole = completed(block)
    return key, levels_of([m[1] for m in messages], whole)[-1][0], messages[-1][2], whole


def sent_down(opened) -> Iterable[tuple]:
    """((group, place of the child), (its message, what the root tells, its proof)) for each child of a block."""
    key, (messages, (told, above)) = opened
    (group, number), messages, whole = completed((key, messages))
    levels = levels_of([m[1] for m in messages], whole)[:-1]
    for message in messages:
        place, proof = message[0], []
        for level in levels:
            first = place - place % ARITY
            run = level[first : first + ARITY]
            del run[place - first]
            proof.append(f"{place - first}{''.join(run)}")
            place //= ARITY
        yield (group, number * BLOCK + message[0]), (message, told, proof + above)


def climbed(mail: RDD, partitions: int) -> tuple[list[RDD], RDD]:
    """The checkpointed blocks of each superstep, and (group, (superstep, digest)) of the roots.
    mail: ((group, block), (place in the block, digest, last of its level, ...))."""
    steps, roots = [], []
    while True:
        blocks = mail.groupByKey(partitions).mapValues(list)
        blocks.checkpoint()
        made = blocks.map(sent_up)
        forwarded = made.filter(lambda x: not x[3])
        n = forwarded.count()
        roots.append(made.filter(lambda x: x[3]).map(lambda x, step=len(steps): (x[0][0], (step, x[1]))))
        steps.append(blocks)
        if not n:
            return steps, mail.context.union(roots)
        mail = forwarded.map(lambda x: ((x[0][0], x[0][1] // BLOCK), (x[0][1] % BLOCK, x[1], x[2])))
        partitions = min(partitions, n // SHARE + 1)


def descended(steps: list[RDD], begun: RDD) -> RDD:
    """((group, place), (message, told, proof)) of the leaves. begun: (group, (superstep of its root, (told, proof of the root)))."""
    below = None
    for step in reversed(range(len(steps))):
        paths = begun.filter(lambda x, step=step: x[1][0] == step).map(lambda x: ((x[0], 0), x[1][1]))
        if below is not None:
            paths = paths.union(below.mapValues(lambda x: x[1:]))
        n = steps[step].getNumPartitions()
        below = steps[step].join(paths.partitionBy(n), n).flatMap(sent_down)
    return below


def outline(partition: int, rows: Iterable) -> Iterable[tuple]:
    """(partition, first group, last group, groups, rows of the last group), where it has rows."""
    first = last = None
    groups = count = 0
    for row in rows:
        if not groups or row[0] != last:
            first = first if groups else row[0]
            last, groups, count = row[0], groups + 1, 0
        count += 1
    if groups:
        yield partition, first, last, groups, count


def starts(outlines: list[tuple]) -> tuple[dict[int, tuple[int, int, bool]], int]:
    """Of each partition: number of its first group, place of its first row, whether its last group goes on; and the number of groups."""
    found, number, count, before = {}, -1, 0, None
    outlines = sorted(outlines)
    for k, (partition, first, last, groups, rows) in enumerate(outlines):
        goes_on = before is not None and before == (first,)
        number, place = (number, count) if goes_on else (number + 1, 0)
        found[partition] = number, place, k + 1 < len(outlines) and outlines[k + 1][1] == last
        number += groups - 1
        count = rows + (place if groups == 1 else 0)
        before = (last,)
    return found, number + 1


def numbered(partition: int, rows: Iterable, begins: dict[int, tuple[int, int, bool]]) -> Iterable[tuple]:
    """The leaves as messages to their blocks. rows: group, id, digest, all columns."""
    held = None
    if partition not in begins:
        return
    number, place, goes_on = begins[partition]
    for row in rows:
        if held is not None:
            ends = held[0] != row[0]
            yield (number, place // BLOCK), (place % BLOCK, held[2], ends, held[3])
            number, place = (number + 1, 0) if ends else (number, place + 1)
        held = row
    yield (number, place // BLOCK), (place % BLOCK, held[2], not goes_on, held[3])


def manifest(rows: DataFrame, id_col: str = "doc_id", group_col: str = "source", leaf_col: str = "leaf") -> DataFrame:
    """rows with subroot, root and proof. rows should be narrow: leaf_col holds the leaves, other columns are carried along."""
    spark = rows.sparkSession
    shared_dir(spark)
    schema = StructType([*rows.schema.fields, StructField("subroot", StringType()), StructField("root", StringType()), StructField("proof", ArrayType(StringType()))])
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [f"`{c}`" for c in (group_col, id_col, leaf_col)]
    dealt = staged(rows, "leaves", compression="snappy").repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    names = rows.columns
    at = [names.index(c) for c in (group_col, id_col, leaf_col)]
    leaves = dealt.rdd.map(lambda r: (r[at[0]], r[at[1]], r[at[2]], tuple(r)))
    begins, n_groups = starts(leaves.mapPartitionsWithIndex(outline).collect())
    if not n_groups:
        return spark.createDataFrame([], schema)
    steps, subroots = climbed(leaves.mapPartitionsWithIndex(lambda k, x: numbered(k, x, begins)), partitions)
    top = subroots.map(lambda x: ((0, x[0] // BLOCK), (x[0] % BLOCK, x[1][1], x[0] == n_groups - 1)))
    top_steps, roots = climbed(top, min(partitions, n_groups // SHARE + 1))
    by_group = descended(top_steps, roots.mapValues(lambda x: (x[0], (x[1], [])))).map(lambda x: (x[0][1], x[1][1:]))
    #: Each group begins at its subroot with the subroot's own proof; both tables have one row a group.
    begun = subroots.join(by_group).mapValues(lambda x: (x[0][0], ((x[0][1], x[1][0]), x[1][1])))
    found = descended(steps, begun).map(lambda x: (*x[1][0][3], *x[1][1], x[1][2]))
    return spark.createDataFrame(found, schema, verifySchema=False)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    kept = leaf()
    deleted = F.when(tampered, leaf(instead={"text": F.replace("text", F.lit("\n"), F.lit(""))})).otherwise(kept)
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", kept.alias("leaf"), deleted.alias("changed"))
    found = manifest(rows).withColumn("folded_root", folded(F.col("changed"), F.col("proof")))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root", F.expr("folded_root = root").alias("verified"))


ORACLE = {
    "op13_merkle_manifest": r"""
WITH RECURSIVE d AS (
  SELECT *, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, 1 + length(doc_id::VARCHAR)), lambda k: ord(substring(doc_id::VARCHAR, k, 1))::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda e, k: xor(e >> 1, 3988292384 * (e & 1)))) AS crc FROM documents),
v AS (
  SELECT doc_id, source, crc,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    text, replace(text, chr(10), '') AS cut FROM d),
t AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN xor(crc, 4294967295) & 1 = 0 THEN sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS changed FROM v),
r AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n FROM t),
up AS (
  SELECT g, 0 AS l, i, leaf AS h, n FROM r
  UNION ALL SELECT g, l + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY g, l, i // 3, n),
groups AS (SELECT g, h AS subroot FROM up WHERE n = 1),
top AS (
  SELECT 0 AS l, g AS i, subroot AS h, (SELECT count(*) FROM groups) AS n FROM groups
  UNION ALL SELECT l + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY l, i // 3, n),
fold AS (
  SELECT g, i AS leaf_at, i, 0 AS l, changed AS h, '' AS p FROM r
  UNION ALL SELECT f.g, f.leaf_at, f.i // 3, f.l + 1, sha256(string_agg(CASE WHEN u.i = f.i THEN f.h ELSE u.h END, '' ORDER BY u.i)), f.p || coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (WHERE u.i <> f.i), '')
  FROM fold f JOIN up u ON u.g = f.g AND u.l = f.l AND u.i // 3 = f.i // 3 AND u.n > 1 GROUP BY f.g, f.leaf_at, f.i, f.l, f.p),
met AS (SELECT g, leaf_at, max_by(h, l) AS h, max_by(p, l) AS p FROM fold GROUP BY g, leaf_at),
topfold AS (
  SELECT g, leaf_at, g AS i, 0 AS l, h, p FROM met
  UNION ALL SELECT f.g, f.leaf_at, f.i // 3, f.l + 1, sha256(string_agg(CASE WHEN u.i = f.i THEN f.h ELSE u.h END, '' ORDER BY u.i)), f.p || coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (WHERE u.i <> f.i), '')
  FROM topfold f JOIN top u ON u.l = f.l AND u.i // 3 = f.i // 3 AND u.n > 1 GROUP BY f.g, f.leaf_at, f.i, f.l, f.p),
ends AS (SELECT g, leaf_at, max_by(h, l) AS folded_root, max_by(p, l) AS p FROM topfold GROUP BY g, leaf_at)
SELECT r.doc_id, r.leaf, groups.subroot, top.h AS root, sha256(ends.p) AS proof_sha256, ends.folded_root, ends.folded_root = top.h AS verified
FROM r JOIN groups USING (g) JOIN ends ON ends.g = r.g AND ends.leaf_at = r.i CROSS JOIN top WHERE top.n = 1
"""
}
