"""Mixing sources to target weights with soft membership.

A classifier learnt from the labelled table gives each document a probability for each
domain. Documents get rates r >= 0 by projected-gradient least squares, so that the
expected tokens of each domain, sum(r x tokens x probability), meet the targets:

    r <- max(0, r - p . y),    y = G^-1 (totals(r) - targets),    G = sum(tokens x p p') where r > 0

The step is the gradient of the misfit weighted by G^-1 in the metric of tokens, whose
Lipschitz constant is 1 over the documents that still have a rate; a step that makes
the misfit larger is halved. The total is such that the ANCHOR domain keeps its
tokens. Targets are shares by domain; by default they follow from CHANGE. Each step is one aggregation over a narrow table of (tokens,
probabilities); only as many numbers as there are domains reach the driver. A rate is
thus a function of the probabilities, so that it needs no join.

The classifier is naive Bayes over the presence of features: bins of surface measures
and VOCABULARY words that tell the domains apart, learnt from at most about SAMPLE
labelled rows (those with the least hash of their id). Totals, targets and rates cover
all documents.

Defined results: a null or empty text has no tokens and the probabilities of its empty
features. Labels that are null count as 0; labels of unknown documents are not used.
Without any labels all domains are equally likely. Repeated rows get equal rates. An
empty table gives an empty result. Other columns are not read. Targets that no rates
can meet are not passed over: rates() tells by how far they were missed (misfit), and
mixed() warns.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.bloom import carried
from sparkloom.llm.common import staged, table, text_of

DOMAINS = ("good", "poor", "toxic")
DOMAIN = "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'good' ELSE 'poor' END"
#: Default targets, as factors of the tokens that each domain has now; shares may be given instead.
CHANGE, ANCHOR = {"good": 1.0, "poor": 0.5, "toxic": 0.5}, "good"
#: Words count if twice their information is past GAIN (a G-test with two degrees of freedom at 0.0001).
SAMPLE, VOCABULARY, GAIN, STEPS, CLOSE = 8_000, 256, 18.4, 24, 1e-6
#: A larger miss of a target is told.
WITHIN = 0.01
SIGNS = "#$%&*!|=<>{}"


def words(text: str) -> str:
    return f"array_remove(split(lower({text}), '[ \\\\x00-\\\\x1F.,;:?!|#$%&*()\"]+'), '')"


def _bin(value: str) -> str:
    """Bins of doubling width."""
    return f"int(round(log2(1 + {value})))"


def surface(text: str, w: str) -> list[str]:
    """Features as words that no text holds, each a measure and its bin."""
    per = f"greatest(1, length({text}))"
    signs = [f"concat('~{c}', {_bin(f'1000D * (length({text}) - length(replace({text}, {chr(39)}{c}{chr(39)}, {chr(39)}{chr(39)}))) / {per}')})" for c in SIGNS]
    return [
        *signs,
        f"concat('~upper', {_bin(f'1000D * regexp_count({text}, {chr(39)}[A-Z]{{3}}{chr(39)}) / {per}')})",
        f"concat('~distinct', int(round(10D * size(array_distinct({w})) / greatest(1, size({w})))))",
        f"concat('~length', {_bin(f'size({w})')})",
        f"concat('~word', int(round(length({text}) / greatest(1, size({w})))))",
    ]


def quoted(values) -> str:
    return "array(" + ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values) + ")"


class Classifier:
    def __init__(self, prior: dict[str, float], weights: dict[str, dict[str, float]], vocabulary: list[str]):
        """prior: log share by domain. weights: log P(feature | domain) by feature and domain."""
        self.prior, self.weights, self.vocabulary = prior, weights, vocabulary

    def features(self, w: str, text: str) -> str:
        own = f"array({', '.join(surface(text, w))})"
        return f"concat({own}, array_intersect({w}, {quoted(self.vocabulary)}))" if self.vocabulary else own

    def posteriors(self, features: str) -> str:
        """SQL of the logits of the domains, an array, from the array of features."""
        listed = sorted(self.weights)
        table = {d: f"map_from_arrays({quoted(listed)}, array({', '.join(f'{self.weights[x][d]!r}D' for x in listed)}))" for d in DOMAINS} if listed else {}
        each = [f"aggregate({features}, {self.prior[d]!r}D, (a, x) -> a + coalesce(try_element_at({table[d]}, x), 0D))" if listed else f"{self.prior[d]!r}D" for d in DOMAINS]
        return f"array({', '.join(each)})"


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """At most about SAMPLE labelled documents: __d domain, __t text."""
    known = labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)").select(F.col("doc_id").alias("__l"), F.expr(DOMAIN).alias("__d"))
    n = known.count()
    #: By the upper 53 bits of a hash, so that the share is fine enough for any number of labels.
    chosen = known.where(F.shiftrightunsigned(F.xxhash64("__l"), 11) < int(min(1.0, SAMPLE / max(1, n)) * (1 << 53))).groupBy("__l").agg(F.min("__d").alias("__d"))
    #: Bounded by SAMPLE, so that the texts stay where they are.
    return docs.select(F.col(id_col).alias("__l"), text_of(text_col).alias("__t")).join(F.broadcast(chosen), "__l").select("__d", "__t")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    sample = staged(labelled(docs, labels, id_col, text_col), "mixing-sample", compression="snappy")
    sizes = {r["__d"]: r["n"] for r in sample.groupBy("__d").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    prior = {d: math.log((sizes.get(d, 0) + 1) / (total + len(DOMAINS))) for d in DOMAINS}
    if not total:
        return Classifier({d: 0.0 for d in DOMAINS}, {}, [])

    def counted(tokens: str) -> DataFrame:
        return sample.select("__d", F.explode(F.expr(f"array_distinct({tokens})")).alias("x")).groupBy("x").agg(*(F.count_if(F.col("__d") == d).alias(d) for d in DOMAINS))

    n = {d: sizes.get(d, 0) for d in DOMAINS}
    #: Mutual information of a word's presence and the domain; the best words reach the driver.
    there = "(" + " + ".join(DOMAINS) + ")"
    part = lambda k, of, own: f"IF({k} > 0, {k} * ln({k} * {float(total)}D / ({of} * {float(own)}D)), 0D)"
    gain = " + ".join(f"{part(d, there, max(1, n[d]))} + {part(f'({n[d]} - {d})', f'({total} - {there})', max(1, n[d]))}" for d in DOMAINS)
    best = counted(words("__t")).where(f"{there} >= 5").select("x", F.expr(gain).alias("g")).where(f"2 * g > {GAIN}").orderBy(F.desc("g"), "x").limit(VOCABULARY)
    vocabulary = sorted(r["x"] for r in best.collect())
    bare = Classifier(prior, {}, vocabulary)
    rows = sample.select("__d", F.expr(words("__t")).alias("__w"), "__t")
    rows = rows.select("__d", F.explode(F.expr(bare.features("__w", "__t"))).alias("x")).groupBy("x").agg(*(F.count_if(F.col("__d") == d).alias(d) for d in DOMAINS)).collect()
    weights = {r["x"]: {d: math.log((r[d] + 0.5) / (n[d] + 1)) for d in DOMAINS} for r in rows}
    #: Only what tells domains apart matters: weights are kept relative to their mean.
    weights = {x: {d: v[d] - sum(v.values()) / len(v) for d in DOMAINS} for x, v in weights.items()}
    return Classifier(prior, weights, vocabulary)


def memberships(docs: DataFrame, model: Classifier, text_col: str = "text", keep: list[str] = ()) -> DataFrame:
    """The columns to keep, __tokens, __p0, __p1, ..."""
    rows = docs.select(*keep, text_of(text_col).alias("__t")).withColumn("__w", F.expr(words("__t")))
    rows = rows.withColumn("__f", F.expr(model.features("__w", "__t"))).withColumn("__tokens", F.size("__w").cast("double"))
    rows = rows.withColumn("__l", F.expr(model.posteriors("__f")))
    rows = rows.withColumn("__e", F.expr("transform(__l, x -> exp(x - array_max(__l)))"))
    #: Formally not deterministic, so that Catalyst computes the probabilities once and moves no filter below them.
    rows = rows.withColumn("__z", F.expr("aggregate(__e, 0D, (a, x) -> a + x)") + F.monotonically_increasing_id() * F.lit(0.0))
    return rows.select(*keep, "__tokens", *((F.get("__e", F.lit(i)) / F.col("__z")).alias(f"__p{i}") for i in range(len(DOMAINS))))


def inverse(m: list[list[float]]) -> list[list[float]]:
    n = len(m)
    rows = [[*r, *(float(i == j) for j in range(n))] for i, r in enumerate(m)]
    for i in range(n):
        k = max(range(i, n), key=lambda r: abs(rows[r][i]))
        rows[i], rows[k] = rows[k], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(n):
            if r != i:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i])]
    return [r[n:] for r in rows]


def rate(steps: list[list[float]], most: float | None = None) -> Column:
    """The rate after these steps, as arithmetic on the probabilities; never above `most`."""
    r = "1D"
    for y in steps:
        r = f"greatest(0D, {r} - ({' + '.join(f'__p{i} * {v!r}D' for i, v in enumerate(y))}))"
        r = f"least({float(most)!r}D, {r})" if most else r
    return F.expr(r)


def solve(parts: DataFrame, target: dict[str, float] | None = None, most: float | None = None) -> tuple[list[list[float]], list[float], list[float]]:
    """parts: __tokens, __p0, ... The steps, the totals wanted and the totals met, at rates from 0 to `most`."""
    k = range(len(DOMAINS))

    def totals(steps, free="__r > 0"):
        """Of each domain at these rates, and G over the documents that are free to move."""
        row = parts.select("*", rate(steps, most).alias("__r")).agg(
            *(F.coalesce(F.sum(F.expr(f"__r * __tokens * __p{i}")), F.lit(0.0)).alias(f"s{i}") for i in k),
            *(F.coalesce(F.sum(F.expr(f"IF({free}, __tokens * __p{i} * __p{j}, 0D)")), F.lit(0.0)).alias(f"g{i}_{j}") for i in k for j in k if i <= j),
        ).first()
        return [row[f"s{i}"] for i in k], [[row[f"g{min(i, j)}_{max(i, j)}"] for j in k] for i in k]

    steps: list[list[float]] = []
    met, g = totals(steps)
    if not sum(met):
        return [], met, met
    if target is None:
        changed = [CHANGE[d] * m for d, m in zip(DOMAINS, met)]
        target = {d: x / sum(changed) for d, x in zip(DOMAINS, changed)}
    anchor = DOMAINS.index(ANCHOR)
    whole = met[anchor] / target[ANCHOR] if met[anchor] > 1e-9 * sum(met) and target[ANCHOR] > 0 else sum(met)
    wanted = [whole * target[d] for d in DOMAINS]
    miss = lambda met: [a - b for a, b in zip(met, wanted)]
    for _ in range(STEPS):
        left = miss(met)
        if max(map(abs, left)) <= CLOSE * whole:
            break
        if most:
            #: A document at a bound is free only if the gradient leads away from it.
            pull = " + ".join(f"__p{i} * {x / whole!r}D" for i, x in enumerate(left))
            _, g = totals(steps, f"(__r > 0 OR ({pull}) < 0) AND (__r < {float(most)!r}D OR ({pull}) > 0)")
        back = inverse([[g[i][j] + 1e-9 * whole * (i == j) for j in k] for i in k])
        step = [sum(back[i][j] * left[j] for j in k) for i in k]
        for _ in range(4):
            new, new_g = totals([*steps, step])
            if sum(x * x for x in miss(new)) < sum(x * x for x in left):
                break
            step = [x / 2 for x in step]
        else:
            break
        steps, met, g = [*steps, step], new, new_g
    return steps, wanted, met


def misfit(wanted: list[float], met: list[float]) -> float:
    """The largest miss of a domain's total, as a share of all that is wanted."""
    return max(abs(a - b) for a, b in zip(wanted, met)) / (sum(wanted) or 1.0)


def rates(docs: DataFrame, labels: DataFrame, target: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, p_<domain>, rate, and how far the targets were missed (misfit, equal in all rows)."""
    parts = staged(memberships(docs, fit(docs, labels, id_col, text_col), text_col, [id_col]), "mixing")
    steps, wanted, met = solve(parts, target)
    return parts.select(id_col, F.col("__tokens").cast("long").alias("n_tokens"), *(F.round(F.col(f"__p{i}"), 6).alias(f"p_{d}") for i, d in enumerate(DOMAINS)), F.round(rate(steps), 6).alias("rate"), F.lit(round(misfit(wanted, met), 6)).alias("misfit"))


def mixed(docs: DataFrame, labels: DataFrame, target: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", repeat: bool = False, seed: int = 0) -> DataFrame:
    """The documents that the rates choose, with all their columns: each stays with
    probability rate (by the hash of its id and text); with repeat, rates above 1 give copies.
    Without repeat no rate is above 1, and what is reported as met is what is kept: a domain
    of which too little is there falls short, with a warning.

    Texts are classified once: the rows are staged with their probabilities."""
    model = fit(docs, labels, id_col, text_col)
    chance = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.when(F.col(id_col).isNull(), F.col(text_col)), F.lit(seed)), 11) / F.lit(float(1 << 53))
    rows = memberships(docs.select(carried(docs), F.col(text_col).alias("__text"), chance.alias("__chance")), model, "__text", ["__row", "__chance"])
    parts = staged(rows, "mixing", compression="snappy")
    most = None if repeat else 1.0
    steps, wanted, met = solve(parts, target, most)
    if (far := misfit(wanted, met)) > WITHIN:
        warnings.warn(f"mixing: no rates meet the targets; wanted {wanted}, met {met}, {far:.1%} off", stacklevel=2)
    chosen = parts.select("__row", F.floor(rate(steps, most) + 1e-9 + F.col("__chance")).alias("__times")).where("__times >= 1")
    if repeat:
        chosen = chosen.select("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times"))))
    return chosen.select("__row.*")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
