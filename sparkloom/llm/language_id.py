"""Language ID by cross-parsing entropy.

Labelled text of each language goes into a suffix automaton, which accepts exactly the
substrings of that text. A document is parsed against each: the longest match from
where the last one ended is one phrase. Phrases times the logarithm of the length of
the labelled text, per letter, estimate the cross entropy; the language with the
least wins, the first by name on a tie.

The automata come from a bounded sample of labelled rows: SAMPLE_DOCS a language, those
with the least hash of their id, and of each a window of at most WINDOW characters that
begins at a hashed place; CHARS letters a language, of which long texts take what short
ones leave; MODEL_CHARS letters in all, shared evenly where there are over 100 languages;
the LANGUAGES with most rows. So the broadcast table is bounded. Every text is parsed
whole and as one: blocks of BLOCK letters run side by side, each as if a phrase began with
it; then the phrase that really comes over from the block before is followed, letter by
letter, to the first place where both parses begin a phrase, as from there they agree.

Defined results: `und` with score 0 for a null text, one without a letter, or where
nothing was learned. Rows without doc_id are neither held out nor learned from.
Repeated rows get equal results; an empty table gives an empty result. Other columns
are not read. Rows are independent: no shuffle, and no group can become hot.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.llm.bloom import carried
from sparkloom.llm.common import table

SAMPLE_DOCS, CHARS, MODEL_CHARS, LANGUAGES = 96, 20_000, 2_000_000, 1000
WINDOW = 8 * CHARS // SAMPLE_DOCS
#: Letters of a block, of its head whose phrase starts are kept, and blocks at a time.
BLOCK, HEAD, LANES = 1024, 192, 2048
NONE, OTHER = 0, 1  # codes: not a letter (runs count once), a letter that no language has learned
DEAD, ROOT = 0, 1
FREE, SPREAD = -1, np.uint64(0x9E3779B97F4A7C15)


class Arcs:
    """Arcs (key -> state) in open addressing, at most half full, so that memory follows the arcs, not the letters."""

    def __init__(self, keys: np.ndarray, to: np.ndarray):
        bits = max(1, (2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.to = np.full(1 << bits, FREE, np.int64), np.full(1 << bits, DEAD, np.int32)
        slot, left = self.slots(keys), np.arange(len(keys))
        while len(left):
            at, first = np.unique(slot[left], return_index=True)
            won = left[first[self.keys[at] == FREE]]
            self.keys[slot[won]], self.to[slot[won]] = keys[won], to[won]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & self.mask

    def as_dict(self) -> dict[int, int]:
        at = np.flatnonzero(self.keys != FREE)
        return dict(zip(self.keys[at].tolist(), self.to[at].tolist()))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * SPREAD) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The state of each key, DEAD where there is no arc."""
        flat = keys.ravel()
        slot = self.slots(flat)
        found = self.keys[slot]
        out = np.where(found == flat, self.to[slot], DEAD)
        left = np.flatnonzero((found != flat) & (found != FREE))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & self.mask
            found = self.keys[slot]
            hit = found == flat[left]
            out[left[hit]] = self.to[slot[hit]]
            on = ~hit & (found != FREE)
            left, slot = left[on], slot[on]
        return out.reshape(keys.shape)


def suffix_arcs(codes: list[int]) -> list[dict[int, int]]:
    """Arcs of the automaton of all substrings: code -> state, by state."""
    arcs: list[dict[int, int]] = [{}, {}]
    link, length, last = [0, 0], [0, 0], ROOT
    for c in codes:
        new = len(arcs)
        arcs.append({})
        link.append(ROOT)
        length.append(length[last] + 1)
        p = last
        while p and c not in arcs[p]:
            arcs[p][c] = new
            p = link[p]
        if p:
            q = arcs[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(arcs)
                arcs.append(dict(arcs[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p and arcs[p].get(c) == q:
                    arcs[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return arcs


def suffix_automaton(codes: list[int], size: int) -> np.ndarray:
    """The same as a table: a row a state, a column a code, DEAD where none."""
    arcs = suffix_arcs(codes)
    out = np.zeros((len(arcs), size), np.int32)
    for s, own in enumerate(arcs):
        for c, to in own.items():
            out[s, c] = to
    return out


def shared(texts: list[np.ndarray], most: int) -> list[np.ndarray]:
    """The texts cut to `most` letters together: an even share each, long ones taking what short ones leave."""
    out, left = list(texts), most
    for k, i in enumerate(sorted(range(len(texts)), key=lambda i: len(texts[i]))):
        out[i] = texts[i][: left // (len(texts) - k)]
        left -= len(out[i])
    return out


class Model:
    def __init__(self, samples: dict[str, list[str]]):
        """samples: texts by language."""
        self.languages = sorted(samples)
        most = min(CHARS, MODEL_CHARS // max(1, len(samples)))
        seen = {x for texts in samples.values() for t in texts for x in t.lower() if x.isalpha()}
        self.codes = {x: OTHER + 1 + i for i, x in enumerate(sorted(seen))}
        self.size = OTHER + 1 + len(self.codes)
        self.lookup = None
        self.weights, roots, states, codes, to, start = [], [], [], [], [], 0
        for name in self.languages:
            texts = samples[name]
            own = [int(c) for t in shared([self.coded(t) for t in texts], most) for c in [NONE, *t]]
            arcs = suffix_arcs(own)
            n = [len(a) for a in arcs]
            states.append(np.repeat(np.arange(len(arcs)), n) + start)
            codes.append(np.fromiter((c for a in arcs for c in a), np.int64, sum(n)))
            to.append(np.fromiter((x for a in arcs for x in a.values()), np.int32, sum(n)) + np.int32(start))
            roots.append(start + ROOT)
            start += len(arcs)
            self.weights.append(math.log2(len(own) + 2))
        #: All automata in one table, the states numbered through; DEAD is no target. A row of first a language.
        self.roots = np.array(roots, np.int32)
        self.first = np.zeros((len(roots), self.size), np.int32)
        self.plain: dict[int, int] = {}
        if roots:
            states, codes, to = np.concatenate(states), np.concatenate(codes), np.concatenate(to)
            self.arcs = Arcs(states * self.size + codes, to)
            own = np.flatnonzero(np.isin(states, self.roots))
            self.first[np.searchsorted(self.roots, states[own]), codes[own]] = to[own]
            self.plain = dict(zip((states * self.size + codes).tolist(), to.tolist()))
        self.lookup = None  # made anew in each worker

    def __getstate__(self):
        """Sent without what the arcs hold already."""
        return {k: v for k, v in self.__dict__.items() if k not in ("plain", "lookup")}

    def __setstate__(self, state):
        self.__dict__ |= state
        self.lookup = None
        self.plain = self.arcs.as_dict() if self.languages else {}

    def coded(self, text: str) -> np.ndarray:
        if self.lookup is None:
            self.lookup = np.zeros(0x110000, np.int32)
            self.lookup[[i for i in range(0x110000) if chr(i).isalpha()]] = OTHER
            for x, c in self.codes.items():
                self.lookup[ord(x)] = c
                if len(x.upper()) == 1 and x.upper().lower() == x:
                    self.lookup[ord(x.upper())] = c
        codes = self.lookup[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        if len(codes) > 1:
            codes = codes[np.concatenate([[True], (codes[1:] != NONE) | (codes[:-1] != NONE)])]
        return codes

    def phrases(self, lanes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """lanes: codes, a column a lane, longest first. By language and lane: the phrases, the
        state at the end, and where in the head a phrase starts."""
        n, roots = len(self.roots), self.roots[:, None]
        state = np.repeat(roots, lanes.shape[1], 1)
        count = np.zeros(state.shape, np.int32)
        heads = np.zeros((min(HEAD, len(lanes)), *state.shape), np.uint8)
        ends = np.searchsorted(-lengths, -np.arange(len(lanes)), "left")  # lanes longer than each step
        for at in range(len(lanes)):
            active = int(ends[at])
            if not active:
                break
            codes = lanes[at, :active]
            s = state[:, :active]
            to = self.arcs(s.astype(np.int64) * self.size + codes)
            miss = to == DEAD
            #: A phrase starts behind a miss and behind the end of another; a code that none can start with is one of its own.
            starts = miss | (s == roots)
            count[:, :active] += starts
            if at < HEAD:
                heads[at, :, :active] = starts
            again = self.first[:, codes]
            state[:, :active] = np.where(miss, np.where(again == DEAD, roots, again), to)
        return count, state, np.ascontiguousarray(heads.transpose(1, 2, 0))

    def parsed(self, coded: list[np.ndarray]) -> np.ndarray:
        """Phrases by language and text."""
        n, size, look, roots = len(self.roots), self.size, self.plain.get, self.roots.tolist()
        total = np.zeros((n, len(coded)), np.int64)
        owner = [(i, at) for i, c in enumerate(coded) for at in range(0, len(c), BLOCK)]
        blocks = [coded[i][at : at + BLOCK] for i, at in owner]
        known: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        order = sorted(range(len(blocks)), key=lambda k: -len(blocks[k]))
        for at in range(0, len(order), LANES):
            part = order[at : at + LANES]
            lengths = np.array([len(blocks[k]) for k in part])
            flat = np.zeros((len(part), lengths[0]), np.int32)
            for j, k in enumerate(part):
                flat[j, : lengths[j]] = blocks[k]
            count, state, heads = self.phrases(np.ascontiguousarray(flat.T), lengths)
            for j, k in enumerate(part):
                known[owner[k]] = count[:, j], state[:, j], heads[:, j]
        for k, (i, at) in enumerate(owner):
            count, state, heads = known[i, at]
            if not at:
                total[:, i], before = count, state.tolist()
                continue
            letters = blocks[k].tolist()
            for language in range(n):
                s, root, more, head = before[language], roots[language], 0, heads[language].tobytes()
                for place, c in enumerate(letters):
                    to = look(s * size + c)
                    if to is None or s == root:
                        if place < len(head) and head[place]:
                            more += int(count[language]) - head.count(1, 0, place)
                            s = int(state[language])
                            break
                        more += 1
                        if to is None:
                            to = look(root * size + c, root)
                    s = to
                total[language, i] += more
                before[language] = s
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        coded = [self.coded(t) if t else np.zeros(0, np.int32) for t in texts]
        has_letter = np.array([bool(len(c)) and bool(c.any()) for c in coded], bool)
        total = self.parsed(coded) if self.languages else np.zeros((0, len(texts)), np.int64)
        names, scores = [], []
        cost = total * np.array(self.weights)[:, None] if self.languages else total
        for i in range(len(texts)):
            if not self.languages or not has_letter[i]:
                names.append("und")
                scores.append(0.0)
                continue
            best = int(np.argmin(cost[:, i]))
            rest = np.delete(cost[:, i], best)
            names.append(self.languages[best])
            scores.append(1.0 - float(cost[best, i] / rest.min()) if len(rest) and rest.min() > 0 else 1.0)
        return names, scores


def pieces(batches, rows: int = 500):
    """Batches cut small, to bound what a worker holds."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from rows that are not held out and have a language."""
    able = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col))
    #: The LANGUAGES with most labelled rows.
    names = able.groupBy(F.col(lang_col).alias("__lang")).count().orderBy(F.desc("count"), "__lang").limit(LANGUAGES).select("__lang")
    able = able.select(F.col(id_col).alias("__id"), F.col(lang_col).alias("__lang"), F.xxhash64(F.col(id_col)).alias("__h"))
    #: Ids only; the rank limit cuts each partition to SAMPLE_DOCS rows a language before the shuffle.
    chosen = able.join(F.broadcast(names), "__lang", "left_semi").withColumn("__r", F.row_number().over(Window.partitionBy("__lang").orderBy("__h", "__id"))).where(f"__r <= {SAMPLE_DOCS}").select("__id", "__lang")
    whole = F.col(text_col).cast("string")
    start = F.lit(1) + F.pmod(F.xxhash64(F.col(id_col), F.lit(1)), F.greatest(F.lit(1), F.length(whole) - F.lit(WINDOW))).cast("int")
    rows = docs.select(F.col(id_col).alias("__id"), F.col(lang_col).alias("__lang"), F.substring(whole, start, F.lit(WINDOW)).alias("__t")).join(F.broadcast(chosen.distinct()), ["__id", "__lang"])
    rows = rows.groupBy("__id", "__lang").agg(F.min("__t").alias("__t")).collect()
    samples: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["__lang"], r["__id"], r["__t"])):
        samples.setdefault(r["__lang"], []).append(r["__t"])
    return Model({k: v[:SAMPLE_DOCS] for k, v in samples.items()})


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in pieces(batches):
            names, scores = shared.value.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[id_col, "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("__t"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double")


def identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents with a language, with all their columns; those judged `und` go."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in pieces(batches):
            names, _ = shared.value.predict(batch.column(0).field(place).to_pylist())
            yield batch.filter(pa.array([x != "und" for x in names], pa.bool_()))

    #: Rows travel as one struct, so columns may have any names.
    rows = docs.select(carried(docs))
    return rows.mapInArrow(run, rows.schema).select("__row.*")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
