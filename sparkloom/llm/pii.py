"""Personal data: base patterns, then candidate gradient boosting.

Base spans are the leftmost non-overlapping matches of four patterns, with their
checks. Beyond them, generators with high recall propose spans (numbers in groups,
account numbers, hexadecimal keys, secrets behind a sign of equality, written-out mail
addresses); boosted trees score each from its format and the words before it; a
threshold of its own, calibrated by kind, selects. A selected span may lie over another
one; redaction merges spans.

The trees are fitted on the driver from labelled_rows(), a bounded table of made-up
candidates (no column of the tables marks personal data), whose features come from the
very expressions that score documents. Two thirds of it fit the trees, one third the
thresholds; both sides come from one generator, so figures of precision on it say little
of documents. The model is fitted once a process and kept.
On documents all is one projection: no shuffle, so no group can become hot.

Places are found without a loop over matches in the engine: the texts between the
matches (split) and the matches (extract) add up to starts. Repeated groups of a
pattern are rewritten as single character classes (dots between labels and blanks
between digits become JOIN first), so that long texts neither backtrack nor recurse.

Defined results: a null or empty text has no spans (base_sha256 is that of the empty
string). Repeated rows get equal results; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import table, text_of

#: Private-use characters: JOIN stands for a dot or blank that joins; a text's own JOIN becomes OTHER.
JOIN, OTHER = "\ue000", "\ue001"
KINDS = ("email", "ip", "card", "phone")
#: The base patterns, over texts in which JOIN replaces joining dots or blanks.
LABEL = "[A-Za-z0-9-]"
LOCAL = f"[A-Za-z0-9._%+{JOIN}-]"
EMAIL = f"(?:(?<!{LOCAL})|\\G){LOCAL}++@{LABEL}++{JOIN}[A-Za-z0-9{JOIN}-]*+"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = f"[0-9][0-9{JOIN}]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Generators of the method: kind, cheap test, pattern. A match may be of any length; runs are taken whole and never tried again from within.
GENERATORS = (
    ("number", "[0-9]", r"(?<![0-9A-Za-z(])[(]?[0-9][0-9 ().-]{5,}[0-9](?![0-9A-Za-z])"),
    ("account", "[A-Z]{2}[0-9]{2}", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}[0-9A-Z]{11,}+(?![0-9A-Za-z])"),
    ("key", "[0-9A-Fa-f]{32}", r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])"),
    ("secret", "[0-9A-Za-z_/+-]{16}", r"(?<![0-9A-Za-z_/+-])[0-9A-Za-z_/+-]{16,}+"),
    ("mail", r"(?i)[\[(]at[\])]", r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?[\[(]dot[\])] ?|\.)[A-Za-z0-9-]{2,}+"),
)
CONTEXT = 24
#: Words before a span, by what they point to.
CUES = (
    ("phone", "phone|tel|telephone|call|fax|mobile|cell|whatsapp|dial|sms"),
    ("id", "ssn|social security|social|passport|tax id|national id|insurance"),
    ("bank", "iban|account|acct|bank|konto|compte|cuenta"),
    ("secret", "token|key|secret|password|passwd|pwd|bearer|credential|auth"),
    ("plain", "version|release|page|section|chapter|figure|table|order|invoice|isbn|issue|price|total|on|in|from|date|id|no|number|commit|sha|md5|digest|checksum|hash"),
)


def q(text: str) -> str:
    """An SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def cumulative(values: str, block: int = 256) -> str:
    """Running sums of an integer array in two levels, so that long arrays stay cheap."""
    blocks = f"transform(sequence(0, greatest(0, int((size({values}) - 1) DIV {block}))), b -> slice({values}, b * {block} + 1, {block}))"
    total = "aggregate(x, 0, (s, v) -> s + v)"
    before = f"aggregate(transform({blocks}, x -> {total}), array(0), (a, v) -> concat(a, array(element_at(a, -1) + v)))"
    inner = "slice(aggregate(x, array({start}), (a, v) -> concat(a, array(element_at(a, -1) + v))), 2, size(x))"
    return f"flatten(zip_with({blocks}, slice({before}, 1, size({blocks})), (x, o) -> {inner.format(start='o')}))"


def found(df: DataFrame, name: str, text: str, pattern: str, when: str, keep: str = "TRUE") -> DataFrame:
    """Add `name`: the spans struct(s start, e end, m match, c text before) of pattern in the SQL expression text."""
    p = q(pattern)
    df = df.withColumn("__x", F.expr(f"CASE WHEN {when} THEN {text} ELSE '' END"))
    df = df.withColumn("__m", F.expr(f"regexp_extract_all(__x, {p}, 0)"))
    df = df.withColumn("__p", F.expr(f"CASE WHEN size(__m) > 0 THEN slice(split(__x, {p}), 1, size(__m)) ELSE array() END"))
    df = df.withColumn("__a", F.expr("transform(__p, (p, i) -> length(p) + CASE WHEN i > 0 THEN length(get(__m, i - 1)) ELSE 0 END)"))
    df = df.withColumn("__s", F.expr(f"CASE WHEN size(__m) > 0 THEN {cumulative('__a')} ELSE array() END"))
    spans = f"transform(__m, (m, i) -> struct(get(__s, i) AS s, get(__s, i) + length(m) AS e, m AS m, right(get(__p, i), {CONTEXT}) AS c))"
    return df.withColumn(name, F.expr(f"filter({spans}, x -> {keep})")).drop("__x", "__m", "__p", "__a", "__s")


def luhn(digits: str) -> str:
    digit = f"int(substring({digits}, -i, 1))"
    return f"aggregate(sequence(1, length({digits})), 0, (a, i) -> a + IF(i % 2 = 1, {digit}, element_at(array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9), {digit} + 1))) % 10 = 0"


def base_spans(docs: DataFrame, text: str) -> DataFrame:
    """docs with one array of spans a base kind; text names a non-null column."""
    own = f"replace({text}, '{JOIN}', '{OTHER}')"
    mail = f"regexp_replace({own}, '(?<={LABEL})[.](?={LABEL})', '{JOIN}')"
    chain = f"regexp_replace({own}, '(?<=[0-9])[ -](?=[0-9])', '{JOIN}')"
    digits = f"replace(x.m, '{JOIN}', '')"
    df = found(docs, "email", mail, EMAIL, f"instr({text}, '@') > 0")
    df = found(df, "ip", text, IP, f"{text} RLIKE '[0-9][.][0-9]'", "forall(split(x.m, '[.]'), p -> length(ltrim('0', p)) <= 3 AND coalesce(try_cast(ltrim('0', p) AS int), 0) <= 255)")
    df = found(df, "card", chain, CARD, f"{text} RLIKE '[0-9][ 0-9-]{{14}}'", f"CASE WHEN length({digits}) BETWEEN 16 AND 19 THEN {luhn(digits)} ELSE FALSE END")
    return found(df, "phone", text, PHONE, f"instr({text}, '+') > 0", "length(regexp_replace(x.m, '[^0-9]', '')) BETWEEN 8 AND 15")


def features(m: str, c: str, generator: int) -> list[str]:
    """SQL expressions of numbers: format of the match m and the text c before it."""
    digits = f"regexp_replace({m}, '[^0-9]', '')"
    return [
        str(generator),
        f"length({digits})",
        f"length({m})",
        f"length(regexp_replace({m}, '[0-9A-Za-z]', ''))",
        f"size(filter(split({m}, '[^0-9]+'), g -> g != ''))",
        f"length(regexp_extract({m}, '^[^0-9]*([0-9]*)', 1))",
        f"length(regexp_extract({m}, '([0-9]*)[^0-9]*$', 1))",
        f"length(regexp_replace({m}, '[^A-Z]', ''))",
        f"length(regexp_replace({m}, '[^.]', ''))",
        f"int({m} RLIKE '^(?:19|20)[0-9]{{2}}[-. ][0-9]{{1,2}}[-. ][0-9]{{1,2}}$' OR {m} RLIKE '^[0-9]{{1,2}}[-. ][0-9]{{1,2}}[-. ](?:19|20)[0-9]{{2}}$')",
        f"int(CASE WHEN length({digits}) BETWEEN 16 AND 19 THEN {luhn(digits)} ELSE FALSE END)",
        f"int({m} RLIKE '^[(]?[0-9]{{3}}[)]?[ .-]{{1,2}}[0-9]{{3}}[ .-][0-9]{{4}}$')",
        f"int({m} RLIKE '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$')",
        f"int({c} RLIKE '[+$#.-][ (]*$')",
        f"int({c} RLIKE '[=:][ ]?[^0-9A-Za-z]?$')",
        f"int({m} RLIKE '[a-z]') + int({m} RLIKE '[A-Z]') + int({m} RLIKE '[0-9]')",
        f"regexp_count({m}, '[0-9][A-Za-z]|[A-Za-z][0-9]|[a-z][A-Z]')",
        *(f"int({c} RLIKE '(?i)(?:^|[^a-z])(?:{words})(?:[^a-z0-9].{{0,6}})?$')" for _, words in CUES),
    ]


def labelled_rows(seed: int = 7, each: int = 40) -> list[tuple[int, str, str, int]]:
    """LABELLED: (generator, match, text before, label), made up; about 30 x each rows."""
    r = random.Random(seed)
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    h = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    u = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))
    cue = dict(CUES)
    any_of = lambda k: r.choice(cue[k].split("|")) + r.choice([" ", ": ", " is ", "=", ' = "'])
    prose = lambda: r.choice(["of the thing ", "was then ", "and ", "", "for all those ", "lorem "])
    rows = []
    for _ in range(each):
        phone = f"{r.choice(['(%s) ', '%s-', '%s.', '%s ']) % d(3)}{d(3)}{r.choice('-. ')}{d(4)}"
        rows += [(0, phone, any_of("phone"), 1), (0, phone, prose(), 1), (0, f"{d(3)}-{d(2)}-{d(4)}", any_of("id"), 1), (0, f"{d(3)}-{d(2)}-{d(4)}", prose(), 1)]
        rows += [(0, d(r.randint(8, 12)), any_of("phone"), 1), (0, d(r.randint(8, 12)), any_of("bank"), 1), (0, d(r.randint(8, 16)), any_of("id"), 1)]
        rows += [(0, d(r.randint(7, 25)), prose(), 0), (0, d(r.randint(7, 25)), any_of("plain"), 0), (0, phone, "+1 ", 0), (0, d(16), prose(), 0)]
        rows += [(0, f"{r.choice(['19', '20'])}{d(2)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}", prose(), 0), (0, f"{r.randint(1, 28)}.{r.randint(1, 12)}.20{d(2)}", any_of("plain"), 0)]
        rows += [(0, ".".join(str(r.randint(0, 300)) for _ in range(4)), prose(), 0), (0, ".".join(str(r.randint(0, 99)) for _ in range(5)), any_of("plain"), 0)]
        rows += [(0, " ".join(d(r.randint(1, 4)) for _ in range(r.randint(3, 6))), prose(), 0), (0, " ".join(d(4) for _ in range(4)), prose(), 0), (0, f"{d(3)} {d(3)} {d(3)}.{d(2)}", any_of("plain"), 0)]
        rows += [(0, f"97{r.choice('89')}-{d(1)}-{d(4)}-{d(4)}-{d(1)}", any_of("plain"), 0)]
        rows += [(1, f"{r.choice(['DE', 'FR', 'GB', 'ES', 'NL'])}{d(r.randint(16, 20))}", any_of("bank"), 1), (1, f"{r.choice(['DE', 'FR', 'GB', 'ES', 'NL'])}{d(r.randint(18, 24))}", prose(), 1)]
        rows += [(1, f"{u(2)}{d(2)}{u(r.randint(11, 25))}", prose(), 0), (1, f"{u(2)}{d(2)}{u(r.randint(11, 25))}", any_of("plain"), 0)]
        rows += [(2, h(r.choice([32, 40, 64])), any_of("secret"), 1), (2, h(r.choice([32, 40, 64])), any_of("plain"), 0), (2, h(r.choice([32, 40, 64])), prose(), 0), (2, d(r.randint(32, 60)), prose(), 0)]
        mixed = "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(r.randint(18, 48)))
        plain = r.choice(["configuration", "internationalisation", "max_retry_count_default", "some-long-slug-of-a-page", "en/some/path/to/page", "responsibilities", "counterrevolutionary"]) + r.choice(["", "_value", "-2024"])
        rows += [(3, r.choice(["sk_live_", "ghp_", "AKIA", ""]) + mixed, any_of("secret"), 1), (3, mixed, f"{r.choice(cue['secret'].split('|'))}{r.choice([': ', '=', ' = '])}", 1)]
        rows += [(3, plain, prose(), 0), (3, plain, any_of("secret"), 0), (3, mixed, prose(), 0), (3, plain, any_of("plain"), 0), (3, mixed, any_of("plain"), 0), (3, "-" * r.randint(16, 60), prose(), 0), (3, d(r.randint(16, 40)), prose(), 0)]
        rows += [(4, f"{h(6)} {r.choice(['[at]', '(at)'])} {h(5)} {r.choice(['[dot]', '(dot)'])} com", prose(), 1), (4, f"{h(6)}(at){h(5)}.org", any_of("phone"), 1)]
    return rows


def boosted(rows: list[list[float]], labels: list[int], rounds: int = 40, rate: float = 0.4, least: int = 8) -> tuple[float, list]:
    """Gradient boosting of depth-2 trees on the logistic loss: (prior, trees)."""
    n, k = len(rows), len(rows[0])
    cuts = [sorted({(a + b) / 2 for a, b in zip(v, v[1:])}) for v in (sorted({r[j] for r in rows}) for j in range(k))]
    cuts = [c if len(c) <= 24 else [c[i * len(c) // 24] for i in range(24)] for c in cuts]
    p0 = sum(labels) / n
    prior = math.log(p0 / (1 - p0))
    score = [prior] * n

    def best(members):
        g, h = sum(grad[i] for i in members), sum(hess[i] for i in members)
        top = (1e-6, None, None)
        for j in range(k):
            for cut in cuts[j]:
                left = [i for i in members if rows[i][j] < cut]
                if least <= len(left) <= len(members) - least:
                    gl, hl = sum(grad[i] for i in left), sum(hess[i] for i in left)
                    gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
                    top = max(top, (gain, j, cut), key=lambda x: x[0])
        return top[1:]

    def leaf(members):
        return rate * sum(grad[i] for i in members) / (sum(hess[i] for i in members) + 1)

    def split(members, depth):
        j, cut = best(members) if depth else (None, None)
        if j is None:
            v = leaf(members)
            for i in members:
                score[i] += v
            return v
        return j, cut, split([i for i in members if rows[i][j] < cut], depth - 1), split([i for i in members if rows[i][j] >= cut], depth - 1)

    trees = []
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-s)) for s in score]
        grad, hess = [y - x for y, x in zip(labels, p)], [x * (1 - x) for x in p]
        if max(map(abs, grad)) < 0.02:
            break
        trees.append(split(list(range(n)), 2))
    return prior, trees


def value(tree, x) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] < tree[1] else tree[3]
    return tree


def tree_sql(tree, x: str) -> str:
    if not isinstance(tree, tuple):
        return f"{tree:.6f}D"
    j, cut, low, high = tree
    return f"IF({x}.f{j} < {cut}, {tree_sql(low, x)}, {tree_sql(high, x)})"


def thresholds(scored: list[tuple[int, float, int]], precision: float) -> list[float]:
    """By generator: the least score from which on this precision is kept, from (generator, score, label);
    where no score keeps it, one above all."""
    found = []
    for g in range(len(GENERATORS)):
        own = sorted(((s, y) for k, s, y in scored if k == g), reverse=True)
        least, good = (own[0][0] + 1 if own else 0.0), 0
        for k, (s, y) in enumerate(own, 1):
            good += y
            if good / k >= precision and (k == len(own) or own[k][0] < s):
                least = (s + own[k][0]) / 2 if k < len(own) else s
        found.append(least)
    return found


FITTED: dict[float, tuple[float, list, list[float]]] = {}


def fit(spark: SparkSession, precision: float = 0.99) -> tuple[float, list, list[float]]:
    """(prior, trees, threshold by generator); the same in every process, so kept."""
    if precision not in FITTED:
        rows = [(i, *x) for i, x in enumerate(labelled_rows())]
        df = spark.createDataFrame(rows, "n int, g int, m string, c string, y int").coalesce(1)
        made = df.select("n", "g", "y", *(F.expr(x if i else "g").cast("double").alias(f"f{i}") for i, x in enumerate(features("m", "c", 0)))).orderBy("n").collect()
        xs, ys = [list(r[3:]) for r in made], [r["y"] for r in made]
        learn = [i for i in range(len(xs)) if (i * 7919) % 3]
        prior, trees = boosted([xs[i] for i in learn], [ys[i] for i in learn])
        scored = [(made[i]["g"], prior + sum(value(t, xs[i]) for t in trees), ys[i]) for i in range(len(xs)) if not (i * 7919) % 3]
        FITTED[precision] = prior, trees, thresholds(scored, precision)
    return FITTED[precision]


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs' ids with base and method spans: email, ip, card, phone, more (arrays of structs)."""
    prior, trees, least = fit(docs.sparkSession)
    df = base_spans(docs.select(F.col(id_col), text_of(text_col).alias("__t")), "__t")
    for g, (kind, test, pattern) in enumerate(GENERATORS):
        df = found(df, "__c", "__t", pattern, f"__t RLIKE {q(test)}")
        named = ", ".join(f"double({x}) AS f{i}" for i, x in enumerate(features("x.m", "x.c", g)))
        score = " + ".join([f"{prior:.6f}D", *(tree_sql(t, "x.f") for t in trees)])
        df = df.withColumn("__f", F.expr(f"transform(__c, x -> struct(x.s AS s, x.e AS e, struct({named}) AS f))"))
        df = df.withColumn(kind, F.expr(f"filter(__f, x -> {score} >= {least[g]:.6f}D)")).drop("__c", "__f")
    return df


def joined(kinds) -> str:
    return "array_join(concat(" + ", ".join(f"transform({k}, x -> concat_ws(':', '{k}', x.s, x.e))" for k in kinds) + "), ',')"


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base spans, their digest, all spans as text, and their number."""
    more = [kind for kind, _, _ in GENERATORS]
    return detect(docs, id_col, text_col).select(
        id_col,
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.expr(joined(KINDS)), 256).alias("base_sha256"),
        F.expr(joined((*KINDS, *more))).alias("spans"),
        sum((F.size(k) for k in (*KINDS, *more)), F.lit(0)).cast("long").alias("n_spans"),
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redacted(table(spark, sf_dir, "documents"))
