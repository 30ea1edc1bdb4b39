from fixtures import TEXTS, docs
from pyspark.sql import functions as F

import corpus_pipeline
from sparkloom.llm import mixing, ngram_join
from sparkloom.llm.common import clear_staged, staged, table


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def made(spark, n=300):
    kinds = ("calm green meadow quiet river", "buy $$$ now ### deal $$$ cheap", "vile idiot scum vile loser")
    rows = [(i, " ".join([kinds[i % 3]] * 6 + [f"w{i}"])) for i in range(n)]
    return docs(spark, rows), labels(spark, [(i, int(i % 3 == 0), int(i % 3 == 2), "t") for i in range(0, n, 2)])


def test_rates_meet_the_targets(spark):
    d, l = made(spark)
    parts = mixing.memberships(d, mixing.fit(d, l), "text", ["doc_id"]).cache()
    target = {"good": 0.6, "poor": 0.3, "toxic": 0.1}
    steps, wanted, met = mixing.solve(parts, target)
    assert max(abs(a - b) for a, b in zip(wanted, met)) < 1e-5 * sum(wanted)
    got = mixing.rates(d, l, target).collect()
    assert len(got) == 300 and all(r.rate >= 0 for r in got)
    best = {r.doc_id: max(("good", "poor", "toxic"), key=lambda x: r[f"p_{x}"]) for r in got}
    assert sum(best[i] == ("good", "poor", "toxic")[i % 3] for i in best) > 290
    totals = {x: sum(r.rate * r.n_tokens * r[f"p_{x}"] for r in got) for x in target}
    assert all(abs(totals[x] / sum(totals.values()) - target[x]) < 1e-3 for x in target)


def test_the_solver_against_brute_force(spark):
    """Projected gradient in plain Python, many small steps, to the same totals."""
    rows = [(float(t), a / 10, b / 10, 1 - a / 10 - b / 10) for t, a, b in ((5, 8, 1), (7, 1, 8), (9, 0, 1), (4, 5, 3), (20, 9, 0))]
    parts = spark.createDataFrame(rows, "__tokens double, __p0 double, __p1 double, __p2 double")
    _, wanted, met = mixing.solve(parts, {"good": 0.7, "poor": 0.2, "toxic": 0.1})
    r = [1.0] * len(rows)
    for _ in range(60_000):
        miss = [sum(x * row[0] * row[1 + d] for x, row in zip(r, rows)) - wanted[d] for d in range(3)]
        r = [max(0.0, x - 2e-3 * row[0] * sum(row[1 + d] * miss[d] for d in range(3))) for x, row in zip(r, rows)]
    assert max(abs(sum(x * row[0] * row[1 + d] for x, row in zip(r, rows)) - met[d]) for d in range(3)) < 1e-3 * sum(wanted)


def plain_features(text, vocabulary):
    """The features of a text, in plain Python."""
    import math
    import re

    w = [x for x in re.split('[ \\x00-\\x1f.,;:?!|#$%&*()"]+', text.lower()) if x]
    half = lambda v: math.floor(v + 0.5)
    scale = lambda v: half(math.log2(1 + v))
    per = max(1, len(text))
    found = [f"~{c}{scale(1000 * text.count(c) / per)}" for c in mixing.SIGNS]
    found += [f"~upper{scale(1000 * len(re.findall('[A-Z]{3}', text)) / per)}", f"~distinct{half(10 * len(set(w)) / max(1, len(w)))}", f"~length{scale(len(w))}", f"~word{half(len(text) / max(1, len(w)))}"]
    return w, [*found, *dict.fromkeys(x for x in w if x in set(vocabulary))]


def test_posteriors_against_brute_force(spark):
    """Naive Bayes counted and applied in plain Python."""
    import math

    d, l = made(spark)
    model = mixing.fit(d, l)
    text = {r.doc_id: r.text for r in d.collect()}
    domain = {r.doc_id: "toxic" if r.toxic else "good" if r.quality else "poor" for r in l.collect()}
    n = {x: sum(v == x for v in domain.values()) for x in mixing.DOMAINS}
    seen = {}
    for i, x in domain.items():
        for f in plain_features(text[i], model.vocabulary)[1]:
            seen.setdefault(f, dict.fromkeys(mixing.DOMAINS, 0))[x] += 1
    logs = {f: {x: math.log((c[x] + 0.5) / (n[x] + 1)) for x in n} for f, c in seen.items()}
    assert set(model.vocabulary) >= {"meadow", "deal", "idiot"}
    for r in mixing.rates(d, l).collect():
        w, features = plain_features(text[r.doc_id], model.vocabulary)
        score = {x: math.log((n[x] + 1) / (len(domain) + 3)) + sum(logs[f][x] - sum(logs[f].values()) / 3 for f in features if f in logs) for x in n}
        top = max(score.values())
        whole = sum(math.exp(v - top) for v in score.values())
        assert r.n_tokens == len(w)
        assert all(abs(r[f"p_{x}"] - math.exp(score[x] - top) / whole) < 2e-6 for x in n)


def test_targets_that_cannot_be_met_are_told(spark):
    import warnings

    d, l = made(spark)
    one_domain = d.where("doc_id % 3 = 0")
    target = {"good": 0.0, "poor": 0.5, "toxic": 0.5}
    assert mixing.rates(one_domain, l, target).first().misfit > mixing.WITHIN
    with warnings.catch_warnings(record=True) as told:
        warnings.simplefilter("always")
        mixing.mixed(one_domain, l, target)
        mixing.mixed(d, l)
    assert sum("no rates meet the targets" in str(x.message) for x in told) == 1


def test_mixing_of_awkward_rows(spark):
    from pyspark.sql import functions as F

    d, l = made(spark, 60)
    more = d.withColumn("meta.x", F.lit("a")).withColumn("__row", F.lit("r")).withColumn("__tokens", F.lit("t")).withColumn("__f", F.col("doc_id"))
    kept = mixing.mixed(more, l)
    assert kept.dtypes == more.dtypes and all((r["meta.x"], r["__row"], r["__tokens"], r["__f"]) == ("a", "r", "t", r.doc_id) for r in kept.collect())
    assert mixing.mixed(more.limit(0), l).count() == 0 and mixing.mixed(docs(spark), labels(spark, [])).columns == docs(spark).columns


def test_mixing_keeps_clean_documents_and_columns(spark):
    d, l = made(spark)
    kept = mixing.mixed(d, l)
    assert kept.columns == d.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert len(set(ids)) == len(ids) and sum(i % 3 == 0 for i in ids) >= 95
    assert sum(i % 3 == 2 for i in ids) < 80
    more = mixing.mixed(d, l, {"good": 0.2, "poor": 0.4, "toxic": 0.4}, repeat=True)
    assert more.count() > 300


def test_mixing_edges(spark):
    l = labels(spark, [(1, 1, None, None), (None, 0, 1, None), (1, 1, 0, None), (9, None, None, None), (77, 0, 0, None), (7, 0, 1, None)])
    got = mixing.rates(docs(spark), l).collect()
    assert len(got) == len(TEXTS) and all(abs(r.p_good + r.p_poor + r.p_toxic - 1) < 1e-5 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (4, 5, 6)} == {0}
    assert mixing.rates(docs(spark, []), l).count() == 0
    assert {r.p_good for r in mixing.rates(docs(spark), labels(spark, [])).collect()} == {round(1 / 3, 6)}


def test_pipeline_stage_by_stage(spark, sf_dir):
    first = table(spark, sf_dir, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "ngram_join", "mixing", "bpe_codec"]
    extra = first.limit(3).withColumn("doc_id", F.col("doc_id") + 10_000).withColumn("text", F.concat("text", F.lit(" ")))
    junk = spark.createDataFrame([(20_000, None, None, None, None), (20_001, "12 34", "en", "s", 5)], first.schema)
    docs_ = first.unionByName(extra).unionByName(junk)
    one = stages["language_id"](spark, docs_, sf_dir)
    assert one.schema == docs_.schema and one.where("doc_id >= 20000").count() == 0 and one.count() == first.count() + 3
    two = stages["exact_dedup"](spark, one, sf_dir)
    import re

    normal = {}
    for r in one.collect():
        normal.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), []).append(r.doc_id)
    assert sorted(r.doc_id for r in two.collect()) == sorted(map(min, normal.values()))
    three = stages["ngram_join"](spark, two, sf_dir)
    joined = ngram_join.join(two).where("doc_id = group_id").collect()
    assert sorted(r.doc_id for r in three.collect()) == sorted(r.doc_id for r in joined)
    four = stages["mixing"](spark, three, sf_dir)
    assert four.columns == first.columns and 0 < four.count() <= three.count()
    assert stages["bpe_codec"](spark, four, sf_dir).count() == four.count()


def test_run(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert got and all(len(r.ids) == r.n_tokens for r in got)


def test_staged_tables_are_cleared(spark):
    df = staged(spark.range(3), "x")
    assert df.count() == 3
    clear_staged(spark)
    try:
        assert spark.read.parquet(df.inputFiles()[0]).count() < 0
    except Exception as e:
        assert "PATH_NOT_FOUND" in str(e)
