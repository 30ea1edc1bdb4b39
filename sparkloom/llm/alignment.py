"""Alignment of the tokens of two tokenizers.

A document's tokens of A (byte-level BPE of a space and the text) and of B (SentencePiece
of the text, which adds that space) cover the same bytes. The tokens are the nodes of a
bipartite graph; an edge links an A and a B token whose byte ranges overlap. Union-find
gives its connected components: the least runs of tokens of which both sides end at one
byte. The members of a component expand to the links, one for each overlapping pair.

Documents are taken together in blocks. A block's row holds each document's distinct id
pairs as numbers into the block's own list of pairs, and that list with its counts. The
counts of all blocks are added up by pair in one shuffle of (pair, count), already summed
by block; each block's list then meets the totals, and its documents are scored by it.
So links never become rows: what is shuffled are the distinct pairs of each block.

Both vocabularies cut texts into words that are encoded on their own (checked when they
are loaded), so each distinct word is encoded once by a bounded memo. A document of over
SEGMENT characters goes through in segments, cut where both begin a word. The best count
of each B id is broadcast: it has one row an id of the vocabulary at most.

Defined results: a null or empty text has no tokens, neither has one whose bytes the
tokens of A or B do not give back (say, one that holds U+2581): counts are zero, the
groups an empty string. Special strings within a text are plain text. Repeated rows count
as rows of their own. Ids may be null. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import staged, table, text_of
from sparkloom.llm.memo import Memo
from sparkloom.llm.ngram_join import staged_small
from sparkloom.llm.simhash import least_roots
from sparkloom.llm.token_files import Encoder

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A pair of ids is one number: A's id, then SHIFT bits of B's.
SHIFT = 20
#: Characters of a block, of a segment of a long text, and of the documents aligned at once.
BLOCK, SEGMENT, TOGETHER = 4 << 20, 1 << 18, 1 << 17
#: Words that a worker keeps of each vocabulary.
ENTRIES = 150_000
MARK = "▁"
CHUNKS = re.compile(r" +[^ ]*")
#: A space between two signs that are not white space: both tokenizers begin a word there.
CUT = re.compile(r"(?<=\S) (?=\S)")


class First:
    """The byte-level vocabulary: ids, and bytes by id."""

    def __init__(self, path: str):
        self.encoder = Encoder(path)
        self.encoder.special = {}  # their strings are plain text here
        self.encoder.memo = Memo(self.encoder.packed, ENTRIES)
        self.lengths = np.zeros(self.encoder.size, np.int64)
        for token, number in self.encoder.library.get_vocab().items():
            self.lengths[number] = len(token)  # a letter stands for a byte
        if self.encoder.size > 1 << SHIFT or any(self.encoder.library.token_to_id(x) is None for x in self.encoder.letters):
            raise ValueError("this vocabulary does not have a token for each byte, or has too many tokens")

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encoder.encoded(text), self.encoder.kind)


class Second:
    """The SentencePiece vocabulary: ids, and bytes by id."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        if size > 1 << SHIFT:
            raise ValueError("this vocabulary has too many tokens")
        pieces = [self.model.id_to_piece(k) for k in range(size)]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace(MARK, " ").encode() for k, p in enumerate(pieces)]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        #: No piece goes on behind a word's end, so no merge does, and words may be encoded one by one.
        self.by_word = not any(MARK in p.lstrip(MARK) for p in pieces)
        self.blank = self.model.piece_to_id(MARK)
        self.memo = Memo(self.packed, ENTRIES)

    def gives_back(self, ids: list[int], text: str) -> bool:
        return b"".join(map(self.bytes.__getitem__, ids)) == text.encode()

    def packed(self, chunk: str) -> bytes | None:
        """The ids of blanks and a word, None where they do not give it back. The model adds the first blank."""
        ids = self.model.encode(chunk[1:]) if len(chunk) > 1 else [self.blank]
        return np.array(ids, np.uint32).tobytes() if self.gives_back(ids, chunk) else None

    def ids(self, text: str) -> np.ndarray | None:
        """Of a text with its first blank; None where the ids do not give it back."""
        if self.by_word:
            parts = list(map(self.memo.__getitem__, CHUNKS.findall(text)))
            if None not in parts:
                return np.frombuffer(b"".join(parts), np.uint32)
        ids = self.model.encode(text[1:])
        return np.array(ids, np.uint32) if ids and self.gives_back(ids, text) else None


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = First(a_path), Second(b_path)
        a, b = (np.arange(len(x.lengths)) for x in (self.a, self.b))
        #: Each id with what may follow it in the text of the groups.
        self.names = [f"{k}{end}" for k in a for end in ",|"] + [f"{k}{end}" for k in b for end in ",;"]
        self.b_at = 2 * len(a)

    def graph(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The links (A token, B token), and the component of each A and of each B token, numbered from the left."""
        ends_a, ends_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        at_a, at_b = np.zeros(ends_a[-1] + 1, bool), np.zeros(ends_a[-1] + 1, bool)
        at_a[ends_a] = True
        at_b[ends_b] = True
        #: Between two neighbouring ends lies a part of one token of each side: every overlap is one such part.
        ends = np.flatnonzero(at_a | at_b)
        left, right = np.cumsum(at_a[ends]) - at_a[ends], np.cumsum(at_b[ends]) - at_b[ends]
        root = least_roots(np.arange(len(a) + len(b)), left, right + len(a))
        own = np.cumsum(root[: len(a)] == np.arange(len(a))) - 1
        return left, right, own, own[root[len(a) :]]

    def aligned(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, text of the groups, distinct pairs, their counts) of each part; parts are aligned side by side."""
        sizes_a, sizes_b = ([len(p[side]) for p in parts] for side in (0, 1))
        a, b = (np.concatenate([p[side] for p in parts]).astype(np.int64) for side in (0, 1))
        left, right, of_a, of_b = self.graph(a, b)
        n = int(of_a[-1]) + 1
        until_a, until_b = np.append(0, np.cumsum(np.bincount(of_a, minlength=n))), np.append(0, np.cumsum(np.bincount(of_b, minlength=n)))
        named = np.empty(len(a) + len(b), np.int64)
        named[np.arange(len(a)) + until_b[of_a]] = 2 * a + (np.arange(len(a)) + 1 == until_a[of_a + 1])
        named[np.arange(len(b)) + until_a[of_b + 1]] = self.b_at + 2 * b + (np.arange(len(b)) + 1 == until_b[of_b + 1])
        end_a, end_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
        groups = np.diff(of_a[end_a - 1] + 1, prepend=0)
        link_ends = np.searchsorted(left, end_a)
        links = np.diff(link_ends, prepend=0)
        keys, counts = np.unique(np.repeat(np.arange(len(parts)), links) << 2 * SHIFT | a[left] << SHIFT | b[right], return_counts=True)
        key_ends = np.searchsorted(keys, np.arange(1, len(parts) + 1) << 2 * SHIFT)
        keys &= (1 << 2 * SHIFT) - 1
        found, before, begun = [], 0, 0
        for k in range(len(parts)):
            until = int(end_a[k] + end_b[k])
            text = "".join(map(self.names.__getitem__, named[before:until].tolist()))[:-1]
            found.append((sizes_a[k], sizes_b[k], int(groups[k]), int(links[k]), text, keys[begun : key_ends[k]], counts[begun : key_ends[k]]))
            before, begun = until, int(key_ends[k])
        return found

    def encoded(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of a text with its first blank, None where they do not give it back."""
        b = self.b.ids(text)
        return None if b is None else (self.a.ids(text), b)

    def segmented(self, text: str) -> tuple | None:
        """As aligned, for one long text with its first blank, segment by segment; the text of the groups comes as its digest and parts."""
        whole = [0, 0, 0, 0]
        pairs, counts, texts, at = [], [], [], 0
        while at < len(text):
            cut = CUT.search(text, at + SEGMENT)
            to = cut.start() if cut else len(text)
            ids = self.encoded(text[at:to])
            if ids is None:
                return None
            *numbers, words, keys, times = self.aligned([ids])[0]
            whole = [x + y for x, y in zip(whole, numbers)]
            texts.append(words)
            pairs.append(keys)
            counts.append(times)
            at = to
        keys, inverse = np.unique(np.concatenate(pairs), return_inverse=True)
        return (*whole, ";".join(texts), keys, np.bincount(inverse, weights=np.concatenate(counts), minlength=len(keys)).astype(np.int64))

    def each(self, texts) -> list[tuple | None]:
        """The alignment of each text (None: no tokens), taken together up to TOGETHER characters."""
        found: list[tuple | None] = []
        parts, places, held = [], [], 0

        def close():
            for place, x in zip(places, self.aligned(parts) if parts else ()):
                found[place] = x
            parts.clear()
            places.clear()

        for text in texts:
            found.append(None)
            if not text:
                continue
            if len(text) > SEGMENT:
                found[-1] = self.segmented(" " + text)
            elif ids := self.encoded(" " + text):
                parts.append(ids)
                places.append(len(found) - 1)
                held += len(text)
                if held >= TOGETHER:
                    close()
                    held = 0
        close()
        return found


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One a Python worker."""
    return Aligner(a_path, b_path)


def paths(a_path: str | None, b_path: str | None) -> tuple[str, str]:
    return a_path or public_tokenizers.path(A_FILE), b_path or public_tokenizers.path(B_FILE)


def token_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """id, groups: the minimal groups of each document, as `a1,a2|b1;a3|b2,b3` with the decimal ids of A and B in order."""
    a_path, b_path = paths(a_path, b_path)

    def run(batches):
        own = aligner(a_path, b_path)
        for batch in batches:
            texts = (t.as_py() for t in batch.column(1))
            ids = iter(batch.column(0).to_pylist())
            while part := list(islice(texts, 64)):
                yield pa.RecordBatch.from_arrays([pa.array(list(islice(ids, len(part))), batch.column(0).type), pa.array([x[4] if x else "" for x in own.each(part)])], names=[id_col, "groups"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(f"`{id_col}`"), text_of(f"`{text_col}`").alias("__t")).mapInArrow(run, f"`{id_col}` {kind}, groups string")


NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None, block: int = BLOCK) -> DataFrame:
    """One row a block of documents of about `block` characters: its documents' ids, numbers, digests of
    groups and numbers of distinct pairs; pairs and counts, the block's own list; place and times, the
    documents' pairs one after the other."""
    a_path, b_path = paths(a_path, b_path)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"block long, ids array<{kind}>, {', '.join(f'{x} array<long>' for x in NUMBERS)}, groups array<string>, distinct_pairs array<long>, pairs array<long>, counts array<long>, place binary, times binary"

    def run(batches):
        own = aligner(a_path, b_path)
        begun, number, held, chars = TaskContext.get().partitionId() << 32, 0, [], 0
        id_type = None

        def row():
            none = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
            docs_ = [x or none for _, x in held]
            codes, place = np.unique(np.concatenate([x[5] for x in docs_]), return_inverse=True)
            times = np.concatenate([x[6] for x in docs_])
            sums = np.bincount(place, weights=times, minlength=len(codes)).astype(np.int64)
            long_list = pa.list_(pa.int64())
            values = [
                ([begun + number], pa.int64()),
                ([[i for i, _ in held]], pa.list_(id_type)),
                *(([[x[k] for x in docs_]], long_list) for k in range(4)),
                ([[x[4] for x in docs_]], pa.list_(pa.string())),
                ([[len(x[5]) for x in docs_]], long_list),
                ([codes], long_list),
                ([sums], long_list),
                ([place.astype(np.uint32).tobytes()], pa.binary()),
                ([times.astype(np.uint32).tobytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in values], names=[x.split()[0] for x in schema.split(", ")])

        for batch in batches:
            id_type = batch.column(0).type
            ids, texts = iter(batch.column(0).to_pylist()), (t.as_py() for t in batch.column(1))
            while part := list(islice(texts, 64)):
                for i, text, x in zip(islice(ids, len(part)), part, own.each(part)):
                    held.append((i, x and (*x[:4], hashlib.sha256(x[4].encode()).hexdigest(), *x[5:])))
                    chars += len(text)
                    if chars >= block:
                        yield row()
                        number, held, chars = number + 1, [], 0
        if held:
            yield row()

    return docs.select(F.col(f"`{id_col}`").alias("__id"), text_of(f"`{text_col}`").alias("__t")).mapInArrow(run, schema)


def totals(found: DataFrame) -> DataFrame:
    """pair, n: how many links of all blocks hold each pair."""
    listed = found.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    return listed.groupBy("pair").agg(F.sum("n").alias("n"))


def b_of(pair: str):
    return F.col(pair).bitwiseAND(F.lit((1 << SHIFT) - 1))


def pair_counts(docs: DataFrame, **kind) -> DataFrame:
    """a, b, n: how many links of the whole table hold each pair of ids."""
    return totals(staged_small(blocks(docs, **kind), "aligned")).select(F.shiftright("pair", SHIFT).alias("a"), b_of("pair").alias("b"), "n")


def alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None, block: int = BLOCK) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best (links whose pair is the most
    frequent of its B id), count_sum (of the links' counts), groups_sha256 ('' without tokens)."""
    found = staged_small(blocks(docs, id_col, text_col, a_path, b_path, block), "aligned")
    counts = staged(totals(found), "pair-counts")
    best = counts.groupBy(b_of("pair").alias("b")).agg(F.max("n").alias("most"))
    listed = found.select(F.col("block").alias("of"), F.posexplode("pairs").alias("at", "pair"))
    met = listed.join(counts, "pair").withColumn("b", b_of("pair")).join(F.broadcast(best), "b").select("of", "at", "n", (F.col("n") == F.col("most")).alias("best"))
    kind = docs.schema[id_col].dataType.simpleString()

    def scored(own: pa.Table, looked: pa.Table) -> pa.Table:
        found, at = [], np.asarray(looked.column("at"))
        n, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        n[at] = np.asarray(looked.column("n"))
        best[at] = np.asarray(looked.column("best")).astype(np.int64)
        for k in range(own.num_rows):
            place, times = (np.frombuffer(own.column(x)[k].as_py(), np.uint32).astype(np.int64) for x in ("place", "times"))
            lists = {x: own.column(x)[k].values for x in ("ids", *NUMBERS, "groups", "distinct_pairs")}
            ends = np.cumsum(np.asarray(lists["distinct_pairs"]))
            starts = ends - np.asarray(lists["distinct_pairs"])
            sums = [np.append(0, np.cumsum(x)) for x in (times * best[place], times * n[place])]
            found.append(pa.table([lists["ids"], *(lists[x] for x in NUMBERS), *(pa.array(s[ends] - s[starts]) for s in sums), lists["groups"]], names=["__id", *NUMBERS, "n_best", "count_sum", "groups_sha256"]))
        return pa.concat_tables(found)

    schema = f"__id {kind}, {', '.join(f'{x} long' for x in NUMBERS)}, n_best long, count_sum long, groups_sha256 string"
    blocks_ = found.select("block", "ids", *NUMBERS, "groups", "distinct_pairs", "place", "times")
    return blocks_.groupBy("block").cogroup(met.groupBy("of")).applyInArrow(scored, schema).withColumnRenamed("__id", id_col)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"))
