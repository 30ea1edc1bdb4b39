"""Token ids as flat binary files with 64-bit document offsets.

Documents are dealt out by ranges of doc_id (and of their texts' hashes, so that rows of
one id or of none may be spread) and sorted within each. A task streams its documents
into sets of three files of the shared folder, named by partition, piece and attempt; a
set is closed and the next one begun when its ids reach PIECE bytes (after GROUP
documents at the earliest):

- .bin  token ids, unsigned little-endian, 16 bits each if the vocabulary fits, else 32
- .off  the place of each document's first id in .bin, and the end: 64-bit
- .ids  the doc_ids: 64-bit (those of null come first and are counted in the manifest)

The manifest names the files of the attempt that succeeded, so a repeated or lost
task leaves nothing that is read; what it left is deleted. Bases come from the prefix
sums of the counts; the manifest has one row a piece. Reading maps the files into memory
where they are local and reads ranges of ROWS documents where they are not.

Defined results: a null or empty text holds only the end id. Null doc_ids come first;
rows of equal doc_id are in the order of their texts' hashes. An empty table gives an
empty result. Other columns are not read. A vocabulary file that asks for other steps
than this module's is refused.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from array import array
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.bpe_codec import BLANKS, LETTERS, NUMBERS, SPACE, byte_letters, is_latin
from sparkloom.llm.common import staged, staging, table, text_of
from sparkloom.llm.memo import Memo

#: The word patterns of the vocabulary, in general and for texts of Latin-1 letters only.
PARTS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
LATIN_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{BLANKS}{LETTERS}{NUMBERS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+")
ROWS, PIECE = 4096, 256 << 20
#: Words that a worker keeps; documents that it encodes before it writes.
ENTRIES, GROUP = 300_000, 256


def store(folder: str) -> tuple[pafs.FileSystem, str]:
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(folder)


class Encoder:
    """The tokenizers library encodes each distinct word once; words are independent of each other."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        before, model = told["pre_tokenizer"] or {}, told["model"]
        known = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before["add_prefix_space"]
        if told["normalizer"] or not known or model.get("type") != "BPE" or model.get("dropout") or any(t[x] for t in told["added_tokens"] for x in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("this vocabulary asks for steps that the encoder does not know")
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.size = self.library.get_vocab_size()
        self.kind = "<u2" if self.size <= 1 << 16 else "<u4"
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.letters = byte_letters()
        self.memo = Memo(self.packed, ENTRIES)

    def packed(self, word: str) -> bytes:
        """The library's model takes a word as the letters of its bytes."""
        tokens = self.library.model.tokenize("".join([self.letters[b] for b in word.encode()]))
        return array("H" if self.kind == "<u2" else "I", [t.id for t in tokens]).tobytes()

    def encoded(self, text: str) -> bytes:
        if any(x in text for x in self.special):
            parts = self.at_special.split(text)
            return b"".join(np.array([self.special[p]], self.kind).tobytes() if p in self.special else self.encoded(p) for p in parts if p)
        return b"".join(map(self.memo.__getitem__, (LATIN_PARTS if is_latin(text) else PARTS).findall(text)))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One a Python worker."""
    return Encoder(path)


MANIFEST = "part int, piece int, name string, kind string, n_docs long, n_nulls long, n_tokens long"
TYPES = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())


def one_piece(fs: pafs.FileSystem, path: str, e: Encoder, end: bytes, groups, most: int) -> tuple[int, int, int]:
    """Write groups of documents (doc_ids, texts) to the three files until the ids reach `most` bytes: documents, null ids, tokens."""
    n_docs = n_nulls = n_tokens = 0
    with fs.open_output_stream(path + ".bin") as tokens, fs.open_output_stream(path + ".off") as offsets, fs.open_output_stream(path + ".ids") as ids:
        for doc_ids, texts in groups:
            own = [e.encoded(t) + end for t in texts.to_pylist()]
            ends = n_tokens + np.cumsum([0, *map(len, own)]) // len(end)
            tokens.write(b"".join(own))
            offsets.write(ends[:-1].astype("<i8").tobytes())
            known = doc_ids.drop_null()
            ids.write(np.asarray(known).astype("<i8").tobytes())
            n_docs, n_nulls, n_tokens = n_docs + len(own), n_nulls + len(own) - len(known), int(ends[-1])
            if n_tokens * len(end) >= most:
                break
        offsets.write(n_tokens.to_bytes(8, "little"))
    return n_docs, n_nulls, n_tokens


def write(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None, piece: int = PIECE) -> DataFrame:
    """Write the files; the manifest with the bases: part, piece, name, kind, n_docs, n_nulls, n_tokens, base."""
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        groups = ((b.column(0).slice(at, GROUP), b.column(1).slice(at, GROUP)) for b in batches for at in range(0, b.num_rows, GROUP))
        first = next(groups, None)
        if first is None:
            return
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        e = encoder(vocabulary)
        end = np.array([end_id], e.kind).tobytes()
        fs, root = store(folder)
        fs.create_dir(root, recursive=True)
        number = 0
        while first is not None:
            name = f"part-{part:06d}-{number:04d}-{attempt}"
            counts = one_piece(fs, f"{root}/{name}", e, end, chain([first], groups), piece)
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((part, number, name, e.kind, *counts), TYPES)], names=[x.split()[0] for x in MANIFEST.split(", ")])
            first = next(groups, None)
            number += 1

    rows = docs.select(F.col(id_col).cast("long").alias("__id"), text_of(text_col).alias("__t"))
    h = F.xxhash64("__t")
    dealt = rows.repartitionByRange(partitions, "__id", h).sortWithinPartitions("__id", h)
    manifest = staged(dealt.mapInArrow(run, MANIFEST), "token-manifest")
    #: One row a piece, whatever the number of documents.
    parts = sorted(manifest.collect(), key=lambda r: (r["part"], r["piece"]))
    sweep(folder, {r["name"] for r in parts})
    bases = [0, *accumulate(r["n_tokens"] for r in parts)]
    return spark.createDataFrame([(*r, b) for r, b in zip(parts, bases)], MANIFEST + ", base long")


def sweep(folder: str, names: set[str]) -> None:
    """Delete what attempts that the manifest does not name have left."""
    fs, root = store(folder)
    for found in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
        if found.base_name.rpartition(".")[0] not in names:
            fs.delete_file(found.path)


class Numbers:
    """A file of numbers, by range: mapped where it is local, read by range where it is not."""

    def __init__(self, fs: pafs.FileSystem, path: str, kind: str):
        self.kind = np.dtype(kind)
        self.mapped = np.memmap(path, kind, "r") if isinstance(fs, pafs.LocalFileSystem) and fs.get_file_info(path).size else None
        self.file = None if self.mapped is not None else fs.open_input_file(path)

    def __getitem__(self, part: slice) -> np.ndarray:
        if self.mapped is not None:
            return self.mapped[part]
        size = self.kind.itemsize
        return np.frombuffer(self.file.read_at((part.stop - part.start) * size, part.start * size), self.kind)


def read(manifest: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document, from the files: id, start, n_tokens, ids_crc32."""

    def run(batches):
        fs, root = store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                places, ids, tokens = (Numbers(fs, f"{root}/{row['name']}{end}", kind) for end, kind in ((".off", "<i8"), (".ids", "<i8"), (".bin", row["kind"])))
                for at in range(0, row["n_docs"], ROWS):
                    to = min(at + ROWS, row["n_docs"])
                    bounds = places[at : to + 1]
                    nulls = max(0, min(to, row["n_nulls"]) - at)
                    own = [None] * nulls + ids[max(0, at - row["n_nulls"]) : max(0, to - row["n_nulls"])].tolist()
                    block = tokens[int(bounds[0]) : int(bounds[-1])]
                    inner = bounds - bounds[0]
                    crc = [zlib.crc32(block[a:b].astype("<u4").tobytes()) for a, b in zip(inner, inner[1:])]
                    yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(bounds[:-1] + row["base"], pa.int64()), pa.array(np.diff(bounds), pa.int64()), pa.array(crc, pa.int64())], names=[id_col, "start", "n_tokens", "ids_crc32"])

    n = manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return manifest.repartition(int(n)).mapInArrow(run, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{staging(spark)}/tokens-{uuid.uuid4().hex}"
    return read(write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder), folder)
