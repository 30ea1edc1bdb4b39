"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs (at line ends, and at sentence ends within a line). The
distinct digests go into the cells of a sketch: each into three cells, one a third,
that hold a count, the XOR of the digests and the XOR of their check values. Two
sketches of one size subtract cell by cell; what both texts share cancels out, and
peeling cells that hold a single digest recovers the digests that differ. If cells
stay that cannot be peeled, both texts are sketched again four times larger.

The fingerprint is the smallest sketch (CELLS cells) as text; equal texts have equal
ones. Likeness is the Jaccard similarity of the digest sets, from the numbers of
distinct digests and the number recovered: (a + b - d) / (a + b + d).

Each document meets the next one (by falling doc_id): ranges of ids are dealt out and
sorted, and the head of the range below goes along as a copy. Only one document a
range travels twice; what reaches the driver is one id a range.

Defined results: a null or empty text has no paragraphs; two such texts have likeness
1. Null ids come last; rows of equal id are in the order of their texts' hashes. A
single document is its own next. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import table, text_of

CELLS, GROW, TRIES = 12, 4, 9
PARAGRAPH = re.compile(r"[^\n.!?]*[\n.!?]+\s*|[^\n.!?]+")
#: Characters handled at once within a task.
PIECE = 4_000_000
C1, C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit mixer, salted."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * C1
    x = (x ^ (x >> np.uint64(27))) * C2
    return x ^ (x >> np.uint64(31))


def digests(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(owner, digest) of the distinct paragraphs of each text, in order of both."""
    own = [{xxhash.xxh64_intdigest(p.strip()) for p in PARAGRAPH.findall(t)} for t in texts]
    sizes = np.array([len(x) for x in own], np.int64)
    return np.repeat(np.arange(len(texts)), sizes), np.fromiter(chain.from_iterable(own), np.uint64, int(sizes.sum()))


class Sketches:
    """A sketch of `cells` cells for each of n texts."""

    def __init__(self, n: int, cells: int, owner: np.ndarray, keys: np.ndarray, salt: int = 0):
        self.n, self.cells, self.salt = n, cells, salt
        self.count = np.zeros(n * cells, np.int32)
        self.key = np.zeros(n * cells, np.uint64)
        self.check = np.zeros(n * cells, np.uint64)
        self.toggle(owner, keys, np.ones(len(keys), np.int32))

    def toggle(self, owner: np.ndarray, keys: np.ndarray, sign: np.ndarray) -> None:
        third, check = self.cells // 3, mixed(keys, 99)
        for part in range(3):
            at = owner * self.cells + part * third + (mixed(keys, 3 * self.salt + part) % np.uint64(third)).astype(np.int64)
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, keys)
            np.bitwise_xor.at(self.check, at, check)

    def rows(self) -> list[bytes]:
        both = np.concatenate([x.reshape(self.n, -1).view(np.uint8).reshape(self.n, -1) for x in (self.count.astype("<i2"), self.key.astype("<u8"), self.check.astype("<u8").astype("<u4"))], 1) if self.n else np.zeros((0, 0), np.uint8)
        return [r.tobytes() for r in both]

    def minus(self, other: Sketches) -> None:
        self.count -= other.count
        self.key ^= other.key
        self.check ^= other.check

    def peel(self) -> tuple[np.ndarray, np.ndarray]:
        """(digests recovered, whether all were) for each text; the sketch must be a difference."""
        found = np.zeros(self.n, np.int64)
        while True:
            at = np.flatnonzero(np.abs(self.count) == 1)
            at = at[self.check[at] == mixed(self.key[at], 99)]
            if not len(at):
                break
            owner, keys, sign = at // self.cells, self.key[at], self.count[at]
            order = np.lexsort((keys, owner))
            owner, keys, sign = owner[order], keys[order], sign[order]
            first = np.concatenate([[True], (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])])
            owner, keys, sign = owner[first], keys[first], sign[first]
            np.add.at(found, owner, 1)
            self.toggle(owner, keys, -sign)
        empty = ((self.count == 0) & (self.key == 0)).reshape(self.n, self.cells).all(1) if self.n else np.zeros(0, bool)
        return found, empty


def _part(owner: np.ndarray, keys: np.ndarray, index: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The digests of the texts in index, which get the numbers 0, 1, ..."""
    place = np.full(n, -1, np.int64)
    place[index] = np.arange(len(index))
    own = place[owner]
    return own[own >= 0], keys[own >= 0]


def likeness(n: int, left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Of n pairs of digest sets, from the difference of their sketches."""
    a, b = np.bincount(left[0], minlength=n), np.bincount(right[0], minlength=n)
    d = np.zeros(n, np.int64)
    open_pairs, cells = np.arange(n), CELLS
    for salt in range(TRIES):
        if not len(open_pairs):
            break
        one = Sketches(len(open_pairs), cells, *_part(*left, open_pairs, n), salt)
        one.minus(Sketches(len(open_pairs), cells, *_part(*right, open_pairs, n), salt))
        found, done = one.peel()
        d[open_pairs[done]] = found[done]
        open_pairs = open_pairs[~done]
        cells *= GROW
    for i in open_pairs:  # digests that share all cells at every size
        d[i] = len(set(left[1][left[0] == i].tolist()) ^ set(right[1][right[0] == i].tolist()))
    return np.where(a + b == 0, 1.0, (a + b - d) / np.maximum(1, a + b + d))


def compared(texts: list[str], following: list[str]) -> dict[str, list]:
    """The columns of documents and the texts that follow them."""
    edited = [t[: len(t) - len(t) // 2] + f[: len(t) // 2] for t, f in zip(texts, following)]
    own, new, nxt = digests(texts), digests(edited), digests(following)
    return {
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        "fingerprint": [base64.b64encode(x).decode() for x in Sketches(len(texts), CELLS, *own).rows()],
        "edited_fingerprint": [base64.b64encode(x).decode() for x in Sketches(len(texts), CELLS, *new).rows()],
        "near_edited": likeness(len(texts), own, new).tolist(),
        "near_next": likeness(len(texts), own, nxt).tolist(),
    }


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and its fingerprint (no order, no shuffle)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows = Sketches(len(texts), CELLS, *digests(texts)).rows()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([base64.b64encode(x).decode() for x in rows], pa.string())], names=[id_col, "fingerprint"])

    return docs.select(id_col, text_of(text_col).alias("__t")).mapInArrow(run, f"`{id_col}` {kind}, fingerprint string")


def in_order(docs: DataFrame, id_col: str, text_col: str, ranges: int) -> DataFrame:
    """Ranges of falling ids: __range, __copy (the head of the range below), __id, __t; sorted within."""
    ids = docs.select(F.col(id_col).cast("long").alias("__id"))
    cuts = ids.select(F.percentile_approx("__id", [i / ranges for i in range(1, ranges)] or [0.5], 100 * ranges)).first()[0] or []
    cuts = sorted(set(cuts))
    #: The number of cuts below an id, in two steps: blocks of cuts, then within one.
    width = max(1, int(len(cuts) ** 0.5))
    tops = f"array({', '.join(f'{c}L' for c in cuts[width - 1 :: width])})" if len(cuts) >= width and cuts else "array(0L)"
    block = f"size(filter({tops}, c -> c < __id))" if cuts else "0"
    listed = f"array({', '.join(f'{c}L' for c in cuts)})" if cuts else "array(0L)"
    bucket = f"CASE WHEN __id IS NULL THEN 0 ELSE {block} * {width} + size(filter(slice({listed}, {block} * {width} + 1, {width}), c -> c < __id)) END" if cuts else "0"
    heads = {r["b"]: r["h"] for r in ids.select(F.expr(bucket).alias("b"), "__id").groupBy("b").agg(F.max("__id").alias("h")).collect()}
    #: One id a range; the lowest range gets the head of the highest.
    order = sorted(heads)
    goes = {b: order[(i + 1) % len(order)] for i, b in enumerate(order)}
    n = max(order, default=0) + 1
    head = "array(" + ", ".join(f"{heads[b]}L" if heads.get(b) is not None else "CAST(NULL AS bigint)" for b in range(n)) + ")"
    target = "array(" + ", ".join(str(goes.get(b, 0)) for b in range(n)) + ")"
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), text_of(text_col).alias("__t")).withColumn("__b", F.expr(bucket))
    own, copy = "struct(__b AS __range, FALSE AS __copy)", f"struct(get({target}, __b) AS __range, TRUE AS __copy)"
    rows = rows.select("__id", "__t", F.expr(f"explode(IF(get({head}, __b) <=> __id, array({own}, {copy}), array({own})))").alias("__to"))
    rows = rows.select("__to.__range", "__to.__copy", "__id", "__t")
    return rows.repartitionById(n, F.col("__range").cast("int")).sortWithinPartitions("__range", "__copy", F.desc_nulls_last("__id"), F.xxhash64("__t"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pairs(batches):
        """(id, text, next text), in order."""
        held, done = None, None
        for batch in batches:
            for part, copy, own, text in zip(*(c.to_pylist() for c in batch.columns)):
                if part == done:
                    continue  # further rows with the head's id
                if held is not None:
                    yield held[1], held[2], text
                held = None if copy else (part, own, text)
                done = part if copy else None

    def run(batches):
        rows, size = [], 0

        def flush():
            ids, texts, following = zip(*rows)
            made = {id_col: list(ids)} | compared(list(texts), list(following))
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(made.values(), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))], names=list(made))

        for row in pairs(batches):
            rows.append(row)
            size += len(row[1]) + 200
            if size >= PIECE:
                yield flush()
                rows, size = [], 0
        if rows:
            yield flush()

    schema = f"`{id_col}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_order(docs, id_col, text_col, ranges).mapInArrow(run, schema)


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_next(table(spark, sf_dir, "documents"))
