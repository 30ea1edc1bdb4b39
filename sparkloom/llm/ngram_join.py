"""N-gram Jaccard join by chosen paths.

A document is the set of its hashed shingles of five words (of all its words, if it
has fewer). Documents with equal sets form a class, found by a 128-bit digest; all
that follows works on classes, so that copies cost nothing.

Each run splits the classes recursively: a class takes the shingles whose hash under
the path so far is below RATE / size, and joins the bucket of each. Two classes take
the same shingle with the same hash, so similar ones share buckets. A bucket of at most
LIMIT classes is compared by brute force; a larger one is split again on further
shingles, up to DEPTH times. What is larger even then is dealt out in pairs of blocks,
each of at most LIMIT classes, so that nothing is dropped and no task holds more. Runs
are repeated until a pair at the threshold is met with probability RECALL.

Brute force first compares sketches (the least hash of each of 64 ranges, one byte
each); only classes with a likely partner have their sets fetched, and every pair is
then checked exactly. A pair that shares several buckets counts in the least of them,
so a bucket gives out one row a class (its links, and its root within the bucket),
never a row a pair. Groups are connected components by alternating large and small
stars, cut by a staged table each round; nothing is collected.

Defined results: a null text counts as empty; documents without words form one class
without links. Repeated rows are copies of one class. Ids may be null (group_id is the
least id that is not). An empty table gives an empty result. Other columns are not read.

Sets are compared as 32-bit hashes: among 1,000 shingles of a pair, a chance match has
odds of about 1 in 10,000 and moves the similarity by a thousandth.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import bloom
from sparkloom.llm.common import staged, table, text_of, with_group
from sparkloom.llm.memo import Memo

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.995
RATES = (1.6, 1.3, 1.3)
LIMIT, RANGES, LIKELY = 1024, 64, 0.5
#: Documents that a worker shingles at once; elements of sets that it numbers at once, by half; rows of a batch.
PIECE, HELD, BATCH = 250, 500_000, 250
CHUNK = 1 << 15
U = np.uint64
C1, C2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * C1
    x = (x ^ (x >> U(27))) * C2
    return x ^ (x >> U(31))


def mix(x: np.ndarray) -> np.ndarray:
    """As mixed, in the array itself."""
    t = x >> U(30)
    for c, shift in ((C1, 27), (C2, 31)):
        x ^= t
        x *= c
        np.right_shift(x, U(shift), out=t)
    x ^= t
    return x


def runs_for(threshold: float, recall: float = RECALL) -> int:
    """Runs after which a pair at the threshold, met at the last depth, is missed with probability 1 - recall at most.

    A pair meets on a shared shingle that both take, so the larger set's share counts; it is
    least where one set holds the other: the threshold itself."""
    shared = threshold
    p = 1.0
    for rate in reversed(RATES):
        p = 1 - math.exp(-rate * shared * p)
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def shingles(text: str, memo: Memo, words: int = WORDS) -> np.ndarray:
    """Distinct hashed shingles, sorted."""
    listed = text.lower().split()
    h = np.fromiter(map(memo.__getitem__, listed), np.uint64, len(listed))
    if not len(h):
        return h
    width = min(words, len(h))
    out = np.zeros(len(h) - width + 1, np.uint64)
    for i in range(width):
        out = out * U(0x100000001B3) + h[i : len(h) - width + 1 + i]
    return np.unique(mixed(out))


def word_memo() -> Memo:
    return Memo(xxhash.xxh64_intdigest)


def sketch(s: np.ndarray) -> bytes:
    """One byte (not 0) of the least hash of each range; 0 where a range is empty."""
    edges = (np.arange(RANGES, dtype=np.uint64) << U(58)).astype(np.uint64)
    at = np.searchsorted(s, edges)
    end = np.append(at[1:], len(s))
    own = s[np.minimum(at, len(s) - 1)] if len(s) else np.zeros(RANGES, np.uint64)
    return np.where(at < end, (own % U(255) + U(1)), U(0)).astype(np.uint8).tobytes()


def taken(s: np.ndarray, paths: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """(index of the path, node) for each shingle that a path takes: by one hash for sets of all sizes, so that they meet."""
    limit = U(min(2**64 - 1, int(2**64 * min(1.0, rate / len(s)))))
    odd = (mixed(paths) | U(1))[:, None]
    owner, nodes = [], []
    for at in range(0, len(s), CHUNK):
        part = s[at : at + CHUNK]
        step = max(1, CHUNK * 8 // len(part))
        for k in range(0, len(paths), step):
            i, j = np.nonzero(mix(part[None, :] * odd[k : k + step]) < limit)
            owner.append(i + k)
            nodes.append(mixed(part[j] ^ mixed(paths[i + k] + U(0x9E3779B97F4A7C15))))
    return np.concatenate(owner), np.concatenate(nodes)


def tree(s: np.ndarray, runs: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(parents, nodes) of each depth."""
    paths, out = mixed(np.arange(1, runs + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15)), []
    for rate in RATES:
        owner, nodes = taken(s, paths, rate) if len(s) and len(paths) else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        out.append((paths[owner], nodes))
        paths = nodes
    return out


def _lists(values: list[np.ndarray]) -> pa.Array:
    sizes = np.cumsum([0, *(len(v) for v in values)])
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(values).view(np.int64) if values else np.zeros(0, np.int64), pa.int64()))


def prepared(docs: DataFrame, id_col: str, text_col: str, runs: int, words: int) -> DataFrame:
    """One row per document: __id, __a, __b (its digest), key, n, sketch, and nodes n1, p2, n2, p3, n3."""
    kind = docs.schema[id_col].dataType
    a, b = bloom.digest(id_col, text_col)

    def run(batches):
        memo = word_memo()
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE):
                part = batch.slice(at, PIECE)
                sets = [shingles(t.as_py(), memo, words) for t in part.column(3)]
                trees = [tree(s, runs) for s in sets]
                columns = [
                    *part.columns[:3],
                    pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([sketch(s) for s in sets], pa.binary()),
                    _lists([t[0][1] for t in trees]),
                    *(_lists([t[d][side] for t in trees]) for d in (1, 2) for side in (0, 1)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["__id", "__a", "__b", "key", "n", "sketch", "n1", "p2", "n2", "p3", "n3"])

    schema = f"__id {kind.simpleString()}, __a long, __b long, key binary, n int, sketch binary, n1 array<long>, p2 array<long>, n2 array<long>, p3 array<long>, n3 array<long>"
    return docs.select(F.col(id_col).alias("__id"), a, b, text_of(text_col).alias("__t")).mapInArrow(run, schema)


def counted(pairs: DataFrame, label: str) -> DataFrame:
    """(node, key) of nodes with several classes, and how many: node, key, c. Copies meet before the shuffle."""
    pairs = pairs.distinct()
    sizes = pairs.groupBy("node").agg(F.count("*").alias("c")).where("c > 1")
    return staged(pairs.join(sizes, "node"), label)


def buckets(t: DataFrame, limit: int) -> DataFrame:
    """bucket, key: every bucket has between two and limit classes."""
    level = counted(t.select(F.explode("n1").alias("node"), "key"), "paths-1")
    out = level.where(F.col("c") <= limit).select(F.col("node").alias("bucket"), "key")
    for depth in (2, 3):
        big = level.where(F.col("c") > limit).select(F.col("node").alias("parent")).distinct()
        below = t.select("key", F.explode(F.arrays_zip(F.col(f"p{depth}").alias("parent"), F.col(f"n{depth}").alias("node"))).alias("s")).select("key", "s.parent", "s.node")
        level = counted(below.join(big, "parent", "left_semi").select("node", "key"), f"paths-{depth}")
        out = out.unionByName(level.where(F.col("c") <= limit).select(F.col("node").alias("bucket"), "key"))
    #: What no path could split: each pair of blocks is a bucket of its own.
    blocks = F.ceil(F.col("c") / (limit // 2)).cast("int")
    last = level.where(F.col("c") > limit).select("node", "key", blocks.alias("b"), F.pmod(F.xxhash64("key"), blocks).cast("int").alias("i"))
    dealt = last.select("node", "key", "i", F.explode(F.sequence(F.lit(0), F.col("b") - 1)).alias("j"))
    return out.unionByName(dealt.select(F.xxhash64("node", F.least("i", "j"), F.greatest("i", "j")).alias("bucket"), "key"))


def by_bucket(rows: DataFrame, run, schema: str) -> DataFrame:
    """run(rows of one bucket) -> rows, for each bucket: streamed in order, one bucket in memory."""

    def stream(batches):
        held, bucket, names = [], None, schema_names

        def made(rows):
            found = run(rows) if len(rows) > 1 else []
            return [found] if found else []

        ready = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != bucket:
                    ready += [x for part in made(held) for x in part]
                    held, bucket = [], row[0]
                held.append(row)
            if ready:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), types)], names=names)
                ready = []
        ready = [x for part in made(held) for x in part]
        if ready:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), types)], names=names)

    kinds = {"bucket": pa.int64(), "key": pa.binary(), "n": pa.int32(), "sketch": pa.binary(), "nodes": pa.list_(pa.int64()), "root": pa.binary(), "links": pa.int64()}
    schema_names = [x.split()[0] for x in schema.split(", ")]
    types = [kinds[x] for x in schema_names]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(stream, schema)


def staged_small(df: DataFrame, label: str) -> DataFrame:
    """staged(), with batches of BATCH rows to the workers, as rows hold whole texts or sets."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    conf.set(name, str(min(BATCH, int(before)) if int(before) > 0 else BATCH))
    try:
        return staged(df, label)
    finally:
        conf.set(name, before)


def lesser(rows) -> np.ndarray:
    """Of each row the buckets below this one that another row here is in too, as bits: pairs with a common bit count there."""
    sizes = [len(r[4]) for r in rows]
    nodes, owner = np.fromiter((x for r in rows for x in r[4]), np.int64, sum(sizes)), np.repeat(np.arange(len(rows)), sizes)
    below = nodes < rows[0][0]
    values, index, times = np.unique(nodes[below], return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1
    common = times[index] > 1
    at, owner = number[index[common]], owner[below][common]
    bits = np.zeros((len(rows), int(times[times > 1].size + 63) // 64), np.uint64)
    np.bitwise_or.at(bits, (owner, at // 64), U(1) << (at % 64).astype(np.uint64))
    return bits


def candidates(rows, threshold: float):
    """(i, array of j > i) of likely pairs that count in this bucket. rows: bucket, key, n, sketch, nodes, ..."""
    n = np.array([r[2] for r in rows])
    marks = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), RANGES)
    full = marks != 0
    bits = lesser(rows)
    for i in range(len(rows) - 1):
        later = n[i + 1 :]
        near = np.minimum(later, n[i]) >= threshold * np.maximum(later, n[i])
        if bits.shape[1]:
            near &= ~(bits[i + 1 :] & bits[i]).any(1)
        near = np.flatnonzero(near) + i + 1
        if len(near):
            same = ((marks[near] == marks[i]) & full[i]).sum(1)
            near = near[same >= LIKELY * (full[near] | full[i]).sum(1)]
            if len(near):
                yield i, near


def likely(threshold: float):
    def run(rows):
        active = np.zeros(len(rows), bool)
        for i, near in candidates(rows, threshold):
            active[i] = True
            active[near] = True
        return [rows[i][:5] for i in np.flatnonzero(active)]

    return run


def shares(sets: list[np.ndarray], near: dict[int, np.ndarray]):
    """(i, array of j, array of what both hold) for the pairs in near. Sets are dealt into
    blocks of at most HELD elements (or one set), and two blocks at a time are numbered."""
    ends, at, block = [], 0, np.zeros(len(sets), np.int64)
    for i, s in enumerate(sets):
        if at and at + len(s) > HELD:
            at = 0
            ends.append(i)
        at += len(s)
        block[i] = len(ends)
    starts, ends = [0, *ends], [*ends, len(sets)]
    pairs: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
    for i, js in near.items():
        for b in np.unique(block[js]):
            pairs.setdefault((int(block[i]), int(b)), []).append((i, js[block[js] == b]))
    for (a, b), listed in sorted(pairs.items()):
        members = [*range(starts[a], ends[a]), *(range(starts[b], ends[b]) if a != b else ())]
        values, index = np.unique(np.concatenate([sets[k] for k in members]), return_inverse=True)
        own = dict(zip(members, np.split(index.astype(np.int32), np.cumsum([len(sets[k]) for k in members])[:-1])))
        has = np.zeros(len(values), bool)
        for i, js in listed:
            has[own[i]] = True
            for at in range(0, len(js), 256):
                part = js[at : at + 256]
                sizes = np.array([len(own[j]) for j in part])
                yield i, part, np.add.reduceat(has[np.concatenate([own[j] for j in part])].astype(np.int32), np.cumsum(sizes) - sizes)
            has[own[i]] = False


def linked(threshold: float):
    def run(rows):
        """rows also have the set, as bytes of 32-bit hashes."""
        rows = sorted(rows, key=lambda r: (r[2], r[1]))  # sets of like size share blocks
        sets = [np.frombuffer(r[5], np.uint32) for r in rows]
        sizes = np.array([len(x) for x in sets])
        links, root = np.zeros(len(rows), np.int64), np.arange(len(rows))
        for i, js, both in shares(sets, dict(candidates(rows, threshold))):
            js = js[both >= threshold * (sizes[i] + sizes[js] - both) - 1e-9]
            links[i] += len(js)
            links[js] += 1
            names = np.unique(root[np.append(js, i)])
            if len(names) > 1:
                root[np.isin(root, names)] = names[0]
        return [(rows[i][1], rows[root[i]][1], int(links[i])) for i in np.flatnonzero(links)]

    return run


def sets_of(docs: DataFrame, reps: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """key, s: the sets of the classes whose representative is in reps (__rep). Texts stay where they are."""
    a, _ = bloom.digest(id_col, text_col)
    blocks = bloom.blocks_for(reps.count())
    near = bloom.passing(docs.select(a.alias("__a"), text_of(text_col).alias("__t")), F.col("__a"), bloom.build(reps.select("__rep"), blocks), blocks)

    def run(batches):
        memo = word_memo()
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE):
                sets = [shingles(t.as_py(), memo, words) for t in batch.column(0).slice(at, PIECE)]
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([np.unique(s.astype(np.uint32)).tobytes() for s in sets], pa.binary())], names=["key", "s"])

    return near.select("__t").mapInArrow(run, "key binary, s binary")


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b. Each node that has an edge, and the least node of its component: a, label."""
    e = staged(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    before = mark(e)
    while before[0]:
        #: Large star: greater neighbours of each node move to its least neighbour.
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count("*").alias("c")), "stars")
        e = with_group(both.where("b > a"), least, ["a"], "c", total=2 * before[0]).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        #: Small star: each node and its lesser neighbours move to the least of them. A node has few of them after a large star.
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        e = e.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("s")).select("s.*").where("a != b").distinct()
        e = staged(e, "edges")
        after = mark(e)
        if after == before:
            break
        before = after
    labels = e.select("a", F.col("b").alias("label"))
    return labels.unionByName(e.select(F.col("b").alias("a"), F.col("b").alias("label")).distinct())


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, words: int = WORDS, limit: int = LIMIT) -> DataFrame:
    """One row per document: __id, __a, __b, class_id, class_size, n_links, label (the class that names its group), group_id."""
    t = staged_small(prepared(docs, id_col, text_col, runs_for(threshold), words), "shingled")
    classes = staged(t.groupBy("key").agg(F.min("__id").alias("class_id"), F.count("*").alias("class_size"), F.min("__a").alias("__rep"), F.min(F.struct("n", "sketch")).alias("__marks")), "classes")
    b = staged(buckets(t, limit), "buckets")
    marks = classes.select("key", "__marks.n", "__marks.sketch")
    nodes = b.groupBy("key").agg(F.collect_set("bucket").alias("nodes"))
    rows = b.join(nodes.join(marks, "key"), "key").select("bucket", "key", "n", "sketch", "nodes")
    active = staged_small(by_bucket(rows, likely(threshold), "bucket long, key binary, n int, sketch binary, nodes array<long>"), "active")
    reps = staged(active.select("key").distinct().join(classes.select("key", "__rep"), "key"), "reps")
    sets = sets_of(docs, reps, id_col, text_col, words).groupBy("key").agg(F.min("s").alias("s"))
    found = staged_small(by_bucket(active.join(sets, "key").select("bucket", "key", "n", "sketch", "nodes", "s"), linked(threshold), "key binary, root binary, links long"), "links")
    links = found.groupBy("key").agg(F.sum("links").alias("n_links"))
    labels = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    near = links.join(labels.select(F.col("a").alias("key"), "label"), "key", "left")
    whole = classes.select("key", "class_id", "class_size").join(near, "key", "left").withColumn("label", F.coalesce("label", "key"))
    whole = staged(whole, "labelled-classes")
    groups = staged(whole.groupBy("label").agg(F.min("class_id").alias("group_id"), F.count("*").alias("__c")), "groups")
    named = with_group(whole, groups, ["label"], "__c").select("key", "class_id", "class_size", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "label", "group_id")
    return with_group(t.select("__id", "__a", "__b", "key"), staged(named, "named"), ["key"], "class_size")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, words: int = WORDS, limit: int = LIMIT) -> DataFrame:
    """One row per document: id, class_id (least id with the same shingles), class_size,
    n_links (other classes at or above the threshold), group_id (least id of the connected documents)."""
    return grouped(docs, id_col, text_col, threshold, words, limit).select(F.col("__id").alias(id_col), "class_id", "class_size", "n_links", "group_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, words: int = WORDS) -> DataFrame:
    """One document of each group, with all its columns: the least id that is not null, of
    equal ids the least digest, and one of repeated rows."""
    rows = staged(grouped(docs, id_col, text_col, threshold, words).select("__id", "__a", "__b", "label"), "grouped")
    a, b = bloom.digest(id_col, text_col)
    return bloom.kept(docs, a, b, staged(bloom.decisions(rows, ["label"]), "decisions"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
