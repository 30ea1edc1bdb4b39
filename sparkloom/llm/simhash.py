"""SimHash near-dedup by a hierarchical index in Gray order.

A fingerprint bit is 1 if it is set in over half of the hashes of a document's shingles
of three words. Equal fingerprints form a class; all that follows works on classes, so
copies cost nothing.

The fingerprints are sorted by their Gray rank, in which neighbours differ in few bits,
and cut into blocks of BLOCK consecutive ones. A node of the index stands for a run of
consecutive fingerprints and holds the bits that all of them share, as a masked pattern
(bits set in all, bits clear in all); an upper node holds what its nodes have in common.
Two nodes differ at least by the bits that both patterns fix and that disagree: these
differences accumulate from the upper nodes to the lower ones, as masks grow. The search
meets the index with itself from the top: a pair of nodes that already differs in more
than BITS bits is given up with all that is below it, others are split into the pairs of
their children. Above the blocks this is one join a level over rows of nodes; a pair of
blocks goes to a task, which carries on with nodes of FAN, then single fingerprints.

No pair of fingerprints becomes a row. A pair of blocks gives at most one edge a
fingerprint, to the least fingerprint of its component within the two; node pairs that
lie whole in one component are not looked at again. Components are those of all edges,
by alternating large and small stars over staged tables. Nothing is sent to the driver
but the number of rows of each sorted partition.

Defined results: a null or empty text, or one of white space, has the fingerprint zero,
linked like any other. Repeated rows are copies of one class. Ids may be null
(component_id is the least id that is not, null where there is none). An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import staged, table, text_of, with_group
from sparkloom.llm.ngram_join import components, staged_small

WORDS, SEED, BITS = 3, 42, 3
#: Fingerprints of a block, of the lowest nodes within it, and children of a node above blocks.
BLOCK, FAN, CHILDREN = 4096, 16, 64
#: Shingles that are hashed at once, and pairs that a task compares at once.
PIECE, PAIRS = 1 << 16, 1 << 20
U = np.uint64
EACH_BIT = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, words: int = WORDS) -> int:
    listed = text.encode().lower().split()  # bytes: A-Z alone, and the six white-space signs
    if not listed:
        return 0
    width = min(words, len(listed))
    joined = b" ".join(listed)
    ends = list(accumulate((len(w) + 1 for w in listed), initial=0))
    n, ones = len(listed) - width + 1, np.zeros(64, np.int64)
    for at in range(0, n, PIECE):
        to = min(n, at + PIECE)
        pieces = [joined[a : b - 1] for a, b in zip(ends[at:to], ends[at + width : to + width])]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.dtype("<u8"), to - at).view(np.uint8).reshape(-1, 8)
        for k in range(8):
            ones[8 * k : 8 * k + 8] += np.bincount(hashes[:, k], minlength=256) @ EACH_BIT
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """__id, fp (64 bits as a long)."""

    def run(batches):
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(1)), U, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["__id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(f"`{id_col}`").alias("__id"), text_of(f"`{text_col}`").alias("__t")).mapInArrow(run, f"__id {kind}, fp long")


def gray_rank(fp: Column) -> Column:
    """The place of a word in Gray order, as a long whose signed order is that of the unsigned place."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(2**63)))


def blocks(classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """The lowest nodes that are rows: node, ones, zeros, fps (in Gray order); every node but the last has `block` fingerprints."""
    spark = classes.sparkSession
    n = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), classes.count() // block + 1))
    rank = gray_rank(F.col("fp"))
    dealt = classes.select("fp").repartitionByRange(n, rank).sortWithinPartitions(rank)
    row = F.monotonically_increasing_id()
    listed = staged(dealt.select("fp", F.shiftright(row, 33).alias("part"), row.bitwiseAND(F.lit((1 << 33) - 1)).alias("place")), "gray-order")
    #: One row a partition.
    sizes = sorted(listed.groupBy("part").agg(F.count("*")).collect())
    bases = spark.createDataFrame([(p, b) for (p, _), b in zip(sizes, accumulate((c for _, c in sizes), initial=0))], "part long, base long")
    placed = listed.join(F.broadcast(bases), "part").select("fp", (F.col("base") + F.col("place")).alias("place"))
    node = F.floor(F.col("place") / block).cast("long")
    found = placed.groupBy(node.alias("node")).agg(F.bit_and("fp").alias("ones"), F.bit_and(F.bitwise_not("fp")).alias("zeros"), F.array_sort(F.collect_list(F.struct("place", "fp"))).alias("__fps"))
    return staged(found.select("node", "ones", "zeros", F.col("__fps.fp").alias("fps")), "gray-blocks")


def met(pairs: DataFrame, children: DataFrame, bits: int) -> DataFrame:
    """The pairs (a, b) of children of each pair of nodes that differ in `bits` shared bits at most, a <= b."""
    parent = F.floor(F.col("node") / CHILDREN).cast("long")
    side = lambda s: children.select(parent.alias(s), F.col("node").alias(f"{s}_node"), F.col("ones").alias(f"{s}_ones"), F.col("zeros").alias(f"{s}_zeros"))
    differ = F.expr("bit_count((a_ones & b_zeros) | (a_zeros & b_ones))")
    found = pairs.join(side("a"), "a").join(side("b"), "b").where((F.col("a_node") <= F.col("b_node")) & (differ <= bits))
    return staged(found.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")), "node-pairs")


def node_pairs(lowest: DataFrame, bits: int = BITS) -> DataFrame:
    """The pairs of blocks that may hold fingerprints within `bits` of each other, from the top of the index down."""
    levels = [lowest.select("node", "ones", "zeros")]
    while levels[-1].count() > 1:
        parent = F.floor(F.col("node") / CHILDREN).cast("long")
        levels.append(staged(levels[-1].groupBy(parent.alias("node")).agg(F.bit_and("ones").alias("ones"), F.bit_and("zeros").alias("zeros")), "gray-nodes"))
    pairs = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(levels[:-1]):
        pairs = met(pairs, level, bits)
    return pairs


def least_roots(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Components as the least member of each, with the edges (i, j) added."""
    while len(i):
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            break
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            above = root[root]
            if (above == root).all():
                break
            root = above
    return root


class Nodes:
    """Two blocks side by side (or one alone) as nodes of FAN neighbours: what each node's fingerprints share."""

    def __init__(self, fps: np.ndarray):
        self.starts = np.arange(0, len(fps), FAN)
        self.ends = np.append(self.starts[1:], len(fps))
        self.ones = np.bitwise_and.reduceat(fps, self.starts)
        self.zeros = np.bitwise_and.reduceat(~fps, self.starts)


def groups_of(nodes: Nodes) -> Nodes:
    """The nodes above: FAN neighbours each."""
    above = object.__new__(Nodes)
    above.starts = np.arange(0, len(nodes.ones), FAN)
    above.ends = np.append(above.starts[1:], len(nodes.ones))
    above.ones = np.bitwise_and.reduceat(nodes.ones, above.starts)
    above.zeros = np.bitwise_and.reduceat(nodes.zeros, above.starts)
    return above


def below(a_nodes: Nodes, b_nodes: Nodes, i: np.ndarray, j: np.ndarray, most: int):
    """The pairs of children of the node pairs (i, j), at most about `most` at a time."""
    wide_a, wide_b = a_nodes.ends[i] - a_nodes.starts[i], b_nodes.ends[j] - b_nodes.starts[j]
    ends = np.cumsum(wide_a * wide_b)
    at = 0
    while at < len(i):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        wa, wb = wide_a[at:to], wide_b[at:to]
        pair = np.repeat(np.arange(to - at), wa * wb)
        own = np.arange(len(pair)) - np.repeat(np.cumsum(wa * wb) - wa * wb, wa * wb)
        yield a_nodes.starts[i[at:to]][pair] + own // wb[pair], b_nodes.starts[j[at:to]][pair] + own % wb[pair]
        at = to


def linked(a: np.ndarray, b: np.ndarray | None, bits: int = BITS) -> np.ndarray:
    """Of the fingerprints of a and then b the least place of each one's component; b None: a with itself."""
    same = b is None
    b = a if same else b
    shift = 0 if same else len(a)
    root = np.arange(len(a) if same else len(a) + len(b))
    la, lb = Nodes(a), Nodes(b)
    ua, ub = groups_of(la), groups_of(lb)
    near = lambda x, y, i, j: np.bitwise_count((x.ones[i] & y.zeros[j]) | (x.zeros[i] & y.ones[j])) <= bits
    i, j = np.divmod(np.arange(len(ua.ones) * len(ub.ones)), len(ub.ones))
    keep = near(ua, ub, i, j) & ((i <= j) if same else True)
    for p, q in below(ua, ub, i[keep], j[keep], PAIRS):
        keep = near(la, lb, p, q) & ((p <= q) if same else True)
        p, q = p[keep], q[keep]
        while len(p):
            part, rest = slice(0, PAIRS // (FAN * FAN)), slice(PAIRS // (FAN * FAN), None)
            #: Nodes that lie whole in one component have nothing to add.
            low, high = np.minimum.reduceat(root[: len(a)], la.starts), np.maximum.reduceat(root[: len(a)], la.starts)
            other = root[shift : shift + len(b)]
            low_b, high_b = np.minimum.reduceat(other, lb.starts), np.maximum.reduceat(other, lb.starts)
            pp, qq = p[part], q[part]
            p, q = p[rest], q[rest]
            new = (low[pp] != high_b[qq]) | (high[pp] != low_b[qq])
            for x, y in below(la, lb, pp[new], qq[new], PAIRS):
                hit = np.bitwise_count(a[x] ^ b[y]) <= bits
                root = least_roots(root, x[hit], y[hit] + shift)
    return root


def edges(lowest: DataFrame, pairs: DataFrame, bits: int = BITS) -> DataFrame:
    """fp, root: a forest of the links in each pair of blocks."""

    def run(batches):
        for batch in batches:
            firsts, seconds = ([np.asarray(x.values).astype(np.int64).view(U) for x in batch.column(k)] for k in (2, 3))
            for own, a, b in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), firsts, seconds):
                whole = a if own[0] == own[1] else np.concatenate([a, b])
                root = linked(a, None if own[0] == own[1] else b, bits)
                joined = np.flatnonzero(root != np.arange(len(root)))
                yield pa.RecordBatch.from_arrays([pa.array(whole[joined].view(np.int64)), pa.array(whole[root[joined]].view(np.int64))], names=["a", "b"])

    side = lambda s: lowest.select(F.col("node").alias(s), F.col("fps").alias(f"{s}_fps"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_fps", "b_fps").mapInArrow(run, "a long, b long")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """One row per document: id, fingerprint (16 hexadecimal digits), component_id (least id
    reachable over fingerprints that differ in `bits` bits at most)."""
    t = staged_small(fingerprints(docs, id_col, text_col, words), "fingerprints")
    classes = staged(t.groupBy("fp").agg(F.min("__id").alias("least_id"), F.count("*").alias("size")), "classes")
    lowest = blocks(classes, block)
    found = staged_small(edges(lowest, node_pairs(lowest, bits), bits), "links")
    labels = components(found).select(F.col("a").alias("fp"), "label")
    whole = staged(classes.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp")), "labelled")
    groups = staged(whole.groupBy("label").agg(F.min("least_id").alias("component_id"), F.count("*").alias("__c")), "groups")
    named = staged(with_group(whole, groups, ["label"], "__c").select("fp", "size", "component_id"), "named")
    return with_group(t, named, ["fp"], "size").select(F.col("__id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))
