import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from compare import duck, rows
from fixtures import TEXTS, docs

from sparkloom.llm import bloom, exact_dedup, ngram_join


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_dedup_edges(spark):
    got = exact_dedup.exact_dedup(docs(spark)).collect()
    assert len(got) == len(TEXTS)
    group = defaultdict(list)
    for i, t in TEXTS:
        group[normal(t)].append(i)
    want = Counter()
    for i, t in TEXTS:
        ids = [x for x in group[normal(t)] if x is not None]
        keep = min(ids) if ids else None
        want[i, keep, len(group[normal(t)]), i == keep, hashlib.sha256(normal(t).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in got) == want


def test_exact_dedup_of_nothing_and_columns(spark):
    empty = docs(spark, [])
    assert exact_dedup.exact_dedup(empty).count() == 0
    kept = exact_dedup.kept_documents(docs(spark))
    assert kept.columns == docs(spark).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 6, 7, 9, 10, 11]


def test_exact_dedup_agrees_with_sql(spark, sf_dir):
    found = exact_dedup.op1_exact_dedup(spark, sf_dir).toPandas()
    assert rows(found) == rows(duck(sf_dir).execute(exact_dedup.ORACLE["op1_exact_dedup"]).fetchdf())


def test_bloom_filter_loses_nothing(spark):
    ids = spark.range(0, 2000, 2)
    bits = bloom.build(ids.selectExpr("xxhash64(id) AS k"), 64)
    passed = {r.id for r in bloom.passing(spark.range(2000), bloom.F.xxhash64("id"), bits, 64).collect()}
    assert {r.id for r in ids.collect()} <= passed
    assert bits.count() <= 64
    blocks = bloom.blocks_for(1000)
    assert bloom.passing(spark.range(2000), bloom.F.xxhash64("id"), bloom.build(ids.selectExpr("xxhash64(id) AS k"), blocks), blocks).count() < 1100
    assert bloom.blocks_for(0) == bloom.LEAST and bloom.blocks_for(10**12) == bloom.BLOCKS


def clashing(spark, rows_):
    """Rows with columns named as those of the operators, one with a dot, and a map."""
    d = spark.createDataFrame([(i, t, "keep me", k, {"a": 1}) for k, (i, t) in enumerate(rows_)], "doc_id long, text string, __h string, `meta.x` long, m map<string, int>")
    return d.selectExpr("*", "'b' AS __block", "'r' AS __row", "'x' AS __a", "'n' AS __n", "'s' AS __stays")


ROWS = [
    (None, "a b c d e f"),
    (None, "unique text here with words"),
    (5, "a b c d e f"),
    (5, "quite another text"),
    (1, "a b c d e f"),
    (7, "same text twice"),
    (7, "same text twice"),
    (7, "same  text twice"),
    (None, "no id twice"),
    (None, "no id twice"),
    (None, None),
    (8, ""),
    (9, None),
]


def one_a_group(rows_, group):
    """Brute force: of each group the least id that is not null."""
    members = defaultdict(list)
    for i, t in rows_:
        members[group(t)].append(i)
    return Counter((g, min((i for i in ids if i is not None), default=None)) for g, ids in members.items())


@pytest.mark.parametrize("capacity", [bloom.CAPACITY, 1])
def test_rows_that_stay(spark, monkeypatch, capacity):
    """Null, reused and repeated ids, repeated rows, clashing columns; filters that hold all and filters too small."""
    monkeypatch.setattr(bloom.kept, "__defaults__", (None, capacity))
    r = random.Random(capacity)
    many = ROWS + [(r.choice([None, *range(40)]), r.choice(["p", "p ", "q r", "s\tt", "s t", *map(str, range(60))])) for _ in range(400)]
    d = clashing(spark, many)
    kept = exact_dedup.kept_documents(d)
    assert kept.dtypes == d.dtypes
    found = kept.collect()
    assert Counter((normal(x.text), x.doc_id) for x in found) == one_a_group(many, normal)
    assert all((many[x["meta.x"]], x["__h"], x["__block"], x.m) == ((x.doc_id, x.text), "keep me", "b", {"a": 1}) for x in found)
    assert exact_dedup.kept_documents(d.limit(0)).count() == 0


def test_one_row_of_each_near_group(spark):
    words = " ".join(f"w{i}" for i in range(30))
    near = [(None, words), (None, words + " x"), (4, words + " y"), (4, words + " y"), (2, "something else"), (2, "and a third"), (None, "alone")]
    d = clashing(spark, [*ROWS, *near])
    kept = ngram_join.one_of_each(d)
    assert kept.dtypes == d.dtypes
    group = lambda t: "near" if t and t.startswith("w0 ") else normal(t).strip()
    assert Counter((group(x.text), x.doc_id) for x in kept.collect()) == one_a_group([*ROWS, *near], group)
    assert ngram_join.one_of_each(d.limit(0)).count() == 0


def brute(rows_):
    memo = ngram_join.word_memo()
    sets = [(i, frozenset(ngram_join.shingles(t or "", memo).tolist())) for i, t in rows_]
    classes = defaultdict(list)
    for i, s in sets:
        classes[s].append(i)
    keys = list(classes)
    links, root = Counter(), {k: k for k in keys}

    def top(k):
        while root[k] is not k:
            k = root[k]
        return k

    least = lambda ids: min((x for x in ids if x is not None), default=None)
    for a in range(len(keys)):
        for b in range(a):
            both = len(keys[a] & keys[b])
            if both and both >= 0.8 * (len(keys[a]) + len(keys[b]) - both) - 1e-9:
                links[keys[a]] += 1
                links[keys[b]] += 1
                root[top(keys[a])] = top(keys[b])
    group = defaultdict(list)
    for k in keys:
        group[top(k)] += classes[k]
    by_key = {k: least(group[top(k)]) for k in keys}
    return Counter((i, least(classes[s]), len(classes[s]), links[s], by_key[s]) for i, s in sets)


def test_join_edges(spark):
    got = Counter(tuple(r) for r in ngram_join.join(docs(spark)).collect())
    assert got == brute(TEXTS)
    assert ngram_join.join(docs(spark, [])).count() == 0


@pytest.mark.parametrize("limit", [ngram_join.LIMIT, 8])
def test_join_against_brute_force(spark, limit):
    """Families of near copies around the threshold, a hot passage, and a large family."""
    r = random.Random(limit)
    vocabulary = [f"w{i}" for i in range(400)]
    hot = " ".join(r.choice(vocabulary) for _ in range(30))
    rows_, n = [], 0
    for family in range(30):
        base = [r.choice(vocabulary) for _ in range(r.randint(3, 90))]
        for _ in range(40 if family == 0 else r.randint(1, 5)):
            words = list(base)
            for _ in range(r.randint(0, 2)):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            rows_.append((n, " ".join(words) + (" " + hot if r.random() < 0.4 else "")))
            n += 1
    got = Counter(tuple(x) for x in ngram_join.join(docs(spark, rows_), limit=limit).collect())
    assert got == brute(rows_)


@pytest.mark.parametrize("limit", [ngram_join.LIMIT, 8])
def test_join_of_seven_and_eight_shingles(spark, limit):
    """Texts of 11 words with one of 12 or many: the sizes 7 and 8 have to meet in buckets of any depth."""
    r = random.Random(limit)
    texts = []
    for family in range(310):
        base = [f"w{r.randrange(10**6)}" for _ in range(11)]
        ends = range(1 if family < 300 else 30)
        texts += [" ".join(base), *(" ".join([*base, f"end{family}-{k}"]) for k in ends)]
    rows_ = list(enumerate(texts))
    got = Counter(tuple(x) for x in ngram_join.join(docs(spark, rows_), limit=limit).collect())
    assert got == brute(rows_)


def test_one_of_each(spark):
    kept = ngram_join.one_of_each(docs(spark, [(3, "a b c d e f g h i j k l m n o p q r s t"), (1, "a b c d e f g h i j k l m n o p q r s t"), (2, "b c d e f g h i j k l m n o p q r s t"), (5, "z y x")]))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5] and "__t" in kept.columns


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r.a: r.label for r in ngram_join.components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_runs_reach_the_recall():
    assert ngram_join.runs_for(0.8) >= 5 and ngram_join.runs_for(0.8, 0.9999) > ngram_join.runs_for(0.8)
