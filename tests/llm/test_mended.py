"""Rates within bounds, long lists of URL rules, spans of any length, rows with awkward columns through all stages."""

import random
import warnings

import pytest
from fixtures import docs
from pyspark.sql import functions as F

import corpus_pipeline
from sparkloom.llm import language_id, mixing, pii, url_filter
from sparkloom.llm.common import table


@pytest.mark.parametrize("target", [{"good": 0.4, "poor": 0.3, "toxic": 0.3}, {"good": 0.7, "poor": 0.2, "toxic": 0.1}, {"good": 0.98, "poor": 0.01, "toxic": 0.01}])
def test_capped_solver_against_brute_force(spark, target):
    rows = [(float(t), a / 10, b / 10, 1 - a / 10 - b / 10) for t, a, b in ((5, 8, 1), (7, 1, 8), (9, 0, 1), (4, 5, 3), (20, 9, 0), (6, 2, 2))]
    parts = spark.createDataFrame(rows, "__tokens double, __p0 double, __p1 double, __p2 double")
    steps, wanted, met = mixing.solve(parts, target, 1.0)
    r = [1.0] * len(rows)
    for _ in range(60_000):
        miss = [sum(x * row[0] * row[1 + d] for x, row in zip(r, rows)) - wanted[d] for d in range(3)]
        r = [min(1.0, max(0.0, x - 1e-3 * row[0] * sum(row[1 + d] * miss[d] for d in range(3)))) for x, row in zip(r, rows)]
    best = sum((sum(x * row[0] * row[1 + d] for x, row in zip(r, rows)) - wanted[d]) ** 2 for d in range(3))
    own = parts.select("*", mixing.rate(steps, 1.0).alias("r")).collect()
    assert all(0 <= x.r <= 1 for x in own)
    kept = [sum(x.r * x["__tokens"] * x[f"__p{d}"] for x in own) for d in range(3)]
    assert kept == pytest.approx(met)
    assert sum((a - b) ** 2 for a, b in zip(met, wanted)) <= best * 1.05 + (1e-3 * sum(wanted)) ** 2


def test_mixed_tells_what_it_keeps(spark, sf_dir):
    """The tokens kept are those reported as met; a target of which too little is there warns."""
    d, l = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = mixing.fit(d, l)
    target = {"good": 0.4, "poor": 0.3, "toxic": 0.3}
    parts = mixing.memberships(d, model, "text", ["doc_id"]).cache()
    steps, wanted, met = mixing.solve(parts, target, 1.0)
    assert mixing.misfit(wanted, met) > mixing.WITHIN
    with pytest.warns(UserWarning, match="no rates meet the targets"):
        kept = mixing.mixed(d, l, target)
    kept = kept.select("doc_id").distinct()
    got = parts.join(kept, "doc_id").agg(*(F.sum(F.col("__tokens") * F.col(f"__p{i}")).alias(str(i)) for i in range(3))).first()
    expected = parts.select("*", mixing.rate(steps, 1.0).alias("r")).agg(*(F.sum(F.expr(f"r * (1 - r) * __tokens * __tokens * __p{i} * __p{i}")).alias(str(i)) for i in range(3))).first()
    for i in range(3):  # chance alone, within four standard deviations
        assert abs(got[str(i)] - met[i]) <= 4 * expected[str(i)] ** 0.5 + 1e-6 * sum(met)


def test_url_rules_of_many_lengths(spark):
    rng = random.Random(5)
    hosts = [f"{'a.' * rng.randrange(4)}h{k % 40}.example.net" for k in range(500)]
    entries = [(h, "/" + "p" * k, rng.choice(["allow", "block"])) for k, h in enumerate(hosts)]
    urls = [f"http://{rng.choice(['', 'x.'])}{rng.choice(hosts)}/{'p' * rng.randrange(520)}{rng.choice(['', '?q', '/z'])}" for _ in range(250)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = url_filter.listed(spark, (), spark.createDataFrame(entries, "host string, path string, verdict string"))
    found = {r.page_id: r.verdict for r in url_filter.judge(pages, listed).collect()}
    for i, u in enumerate(urls):
        host, _, path = u[7:].split("?")[0].partition("/")
        fits = [(len(h) + len(p), h + p, v) for h, p, v in entries if (host == h or host.endswith("." + h)) and ("/" + path).startswith(p)]
        longest = max((f[0] for f in fits), default=0)
        assert found[i] in ({f[2] for f in fits if f[0] == longest} or {"allow"})


@pytest.mark.parametrize("n", [40, 64, 65, 128, 129, 160, 5000])
def test_secrets_of_any_length(spark, n):
    rng = random.Random(n)
    texts = [(0, "token = " + "".join(rng.choice("0123456789abcdef") for _ in range(n))), (1, "api_key=" + "".join(rng.choice("ABCDEFGHabcdefgh0123456789") for _ in range(n)))]
    found = {r.doc_id: r for r in pii.detect(docs(spark, texts)).collect()}
    for i, text in texts:
        start = text.index("=") + 1 + (text[text.index("=") + 1] == " ")
        assert any((x.s, x.e) == (start, len(text)) for kind, _, _ in pii.GENERATORS for x in found[i][kind]), (n, i)


AWKWARD = "doc_id long, text string, lang string, source string, n_chars long, `meta.x` int, __row string, __t string, names string, held_out string, m map<string,int>"


def awkward(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), k, "r", "t", "n", "h", {"a": 1}) for k, (i, t) in enumerate(rows)], AWKWARD)


def test_identified_carries_any_column(spark):
    model = language_id.fit(docs(spark, [(i, f"the cat sat on the mat {i}") for i in range(20)]))
    rows = awkward(spark, [(1, "the cat"), (2, None), (3, "12 34"), (None, "the mat"), (1, "the cat")])
    got = language_id.identified(rows, model)
    assert got.columns == rows.columns and sorted(r["meta.x"] for r in got.collect()) == [0, 3, 4]


def test_all_stages_take_awkward_tables(spark, sf_dir):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    rng = random.Random(2)
    some = [(k, " ".join(rng.choice(words) for _ in range(30))) for k in range(12)]
    some += [some[0], (None, some[1][1]), (None, None), (50, ""), (51, "\n"), (52, "word " * 3000)]
    for rows in ([], some):
        d = awkward(spark, rows)
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            for name, stage in corpus_pipeline.STAGES:
                last = name == corpus_pipeline.STAGES[-1][0]
                out = stage(spark, d, sf_dir)
                assert last or out.columns == d.columns, name
                if not last:
                    d = spark.createDataFrame(out.collect(), d.schema)
                else:
                    out.collect()
