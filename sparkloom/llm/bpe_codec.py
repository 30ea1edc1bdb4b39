"""BPE encoding and decoding by a tokenization automaton.

The merges are compiled one after the other, in rank order, each as a gadget on the
automaton built so far. A state is the token last read; before any merge every state
has an arc for every base symbol. The gadget of the merge (u, v) -> t

- cuts the arc v out of the state behind u, for u v must now be read as t;
- adds an arc t wherever u leads on to v, into a copy of the state behind v.

A copy shares what was cut before it was made and nothing cut later, so a state is
stored as its own cuts, by rank, and the state and rank that it was copied at: the
whole automaton takes one entry a merge (its arcs one by one would be billions). An arc
t leaves a state unless t was cut there, or t's first half was cut before t came to be
(at the same rank for u u, as the leftmost pair merges first).

Arcs are labelled with tokens; over letters the automaton is made deterministic by the
subset construction. A subset holds, for each place where a token may be under way,
the token before that place and the letters since, as a node of the trie of all tokens.
Every prefix of a word has one tokenization, so of the tokens that a letter completes
exactly one has its arc, and the subset that the letter leads to knows that token.
Subsets are numbered and their transitions kept in a table when first met: encoding a
word is one look-up a letter, from its first to its last, and nothing is tried twice
or taken back. The tokens are then read off from the end of the word. Decoding emits
the labels of the arcs that the ids name.

Splitting into words is that of the vocabulary file: special strings, NFC, lower
case, then contractions, runs of letters, single digits, runs of other signs. A file
that asks for other steps is refused.

Defined results: a null or empty text has no tokens. Repeated rows get equal results;
an empty table gives an empty result. Other columns are not read. Rows are
independent, so a lost executor costs only its tasks, and no group can become hot.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm.common import table, text_of
from sparkloom.llm.memo import Memo

NEVER = 1 << 60
#: Subsets and answers about arcs that a worker keeps (when there are more, they are begun anew), and words.
SUBSETS, ARCS, ENTRIES = 150_000, 150_000, 200_000
#: The mark of a word's last letter, and the shift of a state or node in a key.
LAST, KEY, NODE = 1 << 21, 22, (1 << 32) - 1
#: The steps before the merges that this module knows.
NORMALIZER = ["NFC", "Replace", "Lowercase"]
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: White space and the word pattern of the vocabulary.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PARTS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
#: The same for texts of Latin-1 letters only, in plain ranges.
LETTERS, NUMBERS, BLANKS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
LATIN_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{BLANKS}{LETTERS}{NUMBERS}]+")


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where printable, else the next free one from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in plain else next(free)) for b in range(256)]


class Automaton:
    """States and arcs are token ids."""

    def __init__(self, vocab: dict[str, int], merges: list[list[str]], suffix: str = ""):
        self.vocab, self.suffix = vocab, suffix
        self.label = {i: t for t, i in vocab.items()}
        self.cuts: dict[int, dict[int, int]] = {}
        #: token -> (rank it was made at, the first half, the state that its own state is a copy of)
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, (u, v) in enumerate(merges):
            self.gadget(rank, vocab[u], vocab[v], vocab[u + v])
        #: The trie of all tokens: node and letter -> node; the token of a node, or -1.
        self.children: dict[int, int] = {}
        self.token_at = [-1]
        for token, i in vocab.items():
            at, last = 0, suffix and token.endswith(suffix) and token != suffix
            spelled = self.letters(token[: -len(suffix)], True) if last else self.letters(token, False)
            for letter in spelled:
                key = at << KEY | letter
                if key not in self.children:
                    self.children[key] = len(self.token_at)
                    self.token_at.append(-1)
                at = self.children[key]
            self.token_at[at] = i
        #: Nodes that lead on; no token is under way at others.
        self.inner = {key >> KEY for key in self.children}
        self.known: dict[int, bool] = {}
        self.length = {i: len(t.removesuffix(suffix) if suffix else t) for t, i in vocab.items()}
        self.restart()

    @staticmethod
    def letters(word: str, ends: bool) -> list[int]:
        found = list(map(ord, word))
        if ends and found:
            found[-1] |= LAST
        return found

    def gadget(self, rank: int, u: int, v: int, t: int) -> None:
        self.cuts.setdefault(u, {})[v] = rank
        self.made[t] = (rank, u, v)

    def cut_at(self, state: int, token: int) -> int:
        """The least rank at which the arc was cut out of the state."""
        least, until = NEVER, NEVER
        while True:
            rank = self.cuts.get(state, {}).get(token, NEVER)
            if rank < until:
                least = min(least, rank)
            if state not in self.made:
                return least
            until, _, state = self.made[state]

    def arc(self, state: int, token: int) -> bool:
        """Whether the state behind the token `state` has an arc for the token."""
        there = self.known.get(state << 32 | token)
        if there is not None:
            return there
        there, until, t = True, NEVER - 1, token
        while there:
            there = self.cut_at(state, t) > until
            if t not in self.made:
                break
            until, t, _ = self.made[t]
        if len(self.known) >= ARCS:
            self.known.clear()
        self.known[state << 32 | token] = there
        return there

    def restart(self) -> None:
        """The table with the first subset alone: nothing read, no token before."""
        self.table: dict[int, int] = {}
        #: A token under way: the token before it, from 1 (0 for none), and its node, in one number.
        self.subsets: list[tuple[int, ...]] = [(0,)]
        self.numbers = {self.subsets[0]: 0}
        #: The token that ends where a subset stands.
        self.ends = [-1]

    def step(self, subset: int, letter: int) -> int:
        """The subset behind the letter, entered into the table."""
        if len(self.subsets) >= SUBSETS:
            kept = self.subsets[subset]
            token = self.ends[subset]
            self.restart()
            if subset:
                subset = self.numbers[kept] = 1
                self.subsets.append(kept)
                self.ends.append(token)
        found, token = [], -1
        children, inner, token_at = self.children.get, self.inner, self.token_at
        for under_way in self.subsets[subset]:
            before, node = under_way >> 32, children((under_way & NODE) << KEY | letter)
            if node is not None:
                if node in inner:
                    found.append(before << 32 | node)
                t = token_at[node]
                if token < 0 <= t and (not before or self.arc(before - 1, t)):
                    token = t
        if token < 0:
            raise ValueError("the vocabulary does not spell this word")
        made = (*found, token + 1 << 32)
        number = self.numbers.get(made)
        if number is None:
            number = self.numbers[made] = len(self.subsets)
            self.subsets.append(made)
            self.ends.append(token)
        self.table[subset << KEY | letter] = number
        return number

    def path(self, word: str) -> list[int]:
        """The tokens of a word: one transition a letter, then back over the tokens that end at each place."""
        at, ends, look, suffix = 0, [], self.table.get, bool(self.suffix)
        for letter in self.letters(word, suffix):
            to = look(at << KEY | letter)
            if to is None:
                to = self.step(at, letter)
                look = self.table.get
            at = to
            ends.append(self.ends[at])
        found, place = [], len(ends)
        while place:
            token = ends[place - 1]
            found.append(token)
            place -= self.length[token]
        return found[::-1]


class Codec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self.refuse_others(told)
        model = told["model"]
        self.automaton = Automaton(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        self.letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.labels = self.automaton.label | {i: t for t, i in self.special.items()}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        #: word -> ids
        self.memo = Memo(self.ids, ENTRIES)

    @staticmethod
    def refuse_others(told: dict) -> None:
        """Raise unless the file asks for the steps of this module."""
        steps = [x["type"] for x in (told["normalizer"] or {}).get("normalizers", [])]
        before = (told["pre_tokenizer"] or {}).get("pretokenizers", [])
        known = steps == NORMALIZER and [x["type"] for x in before] == ["Split", "ByteLevel"] and before[0]["pattern"] == {"Regex": WORDS}
        model = told["model"]
        plain = not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
        if not known or not plain or told["decoder"] or any(t[x] for t in told["added_tokens"] for x in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("this vocabulary asks for steps that the codec does not know")

    def ids(self, word: str) -> tuple[int, ...]:
        #: Printable ASCII letters stand for themselves.
        return tuple(self.automaton.path(word if word.isascii() and word.isprintable() else "".join([self.letters[b] for b in word.encode()])))

    @staticmethod
    def words(text: str) -> list[str]:
        if is_latin(text):
            return LATIN_PARTS.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        #: Each letter on its own: no special form of a final letter.
        return PARTS.findall("".join(map(str.lower, text)) if "Σ" in text else text.lower())

    def encode(self, text: str) -> list[int]:
        parts = self.at_special.split(text) if any(x in text for x in self.special) else [text]
        found: list[int] = []
        for part in parts:
            if part in self.special:
                found.append(self.special[part])
            else:
                found += chain.from_iterable(map(self.memo.__getitem__, self.words(part)))
        return found

    def decode(self, ids: list[int]) -> str:
        """The labels of the arcs, parted by blanks, as the vocabulary file has no decoder of its own."""
        return " ".join(map(self.labels.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One a Python worker."""
    return Codec(path)


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, ids and the decoded text as digests. vocabulary: its file on every node."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        c = codec(vocabulary)
        for batch in batches:
            n, ids, decoded = [], [], []
            for text in batch.column(1):
                own = c.encode(text.as_py())
                n.append(len(own))
                ids.append(hashlib.sha256(" ".join(map(str, own)).encode()).hexdigest())
                decoded.append(hashlib.sha256(c.decode(own).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(id_col, text_of(text_col).alias("__t")).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def token_ids(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, ids (array of int), decoded_sha256."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        c = codec(vocabulary)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                ids, digests = [], []
                for text in batch.column(1):
                    own = c.encode(text.as_py())
                    ids.append(np.array(own, np.int32))
                    digests.append(hashlib.sha256(c.decode(own).encode()).hexdigest())
                ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids), pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(map(len, ids)), pa.int64()), lists, pa.array(digests, pa.string())], names=[id_col, "n_tokens", "ids", "decoded_sha256"])

    return docs.select(id_col, text_of(text_col).alias("__t")).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids array<int>, decoded_sha256 string")


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
