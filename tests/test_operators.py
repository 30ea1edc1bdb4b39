import pytest
from pyspark.sql import functions as F

from sparkloom.operators import gates, graph, inventory, linking, vectors
from sparkloom.plans import pipeline, prompts
from sparkloom.sources import files as source
from sparkloom.streaming import progress


def test_query_is_immutable_and_typed(spark):
    df = spark.createDataFrame([("a/x.java", "java", 10, "UI"), ("b/y.jsp", "jsp", 20, None)], "path string, language string, size_bytes long, layer string")
    q = inventory.files(df)
    assert q.language("java").count().first()["n"] == 1 and q.count().first()["n"] == 2
    assert q.layer("Other").execute().first()["path"] == "b/y.jsp" and q.layer("UI").execute().count() == 1
    assert q.path_regex("(").execute().count() == 0 and q.min_size(0).tests == ()
    assert q.language("java").language("jsp").exists() and not q.max_size(5).exists()


def test_closure_of_a_cycle(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "a int, b int")
    got = {(r.a, r.b, r.depth) for r in graph.closure(e).collect()}
    assert got == {(1, 2, 1), (2, 3, 1), (3, 1, 1), (3, 4, 1), (1, 3, 2), (2, 1, 2), (2, 4, 2), (3, 2, 2), (1, 4, 3)}


def test_closure_of_a_long_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(53)], "a int, b int")
    got = {(r.a, r.b, r.depth) for r in graph.closure(e).collect()}
    assert got == {(i, j, j - i) for i in range(54) for j in range(i + 1, 54)}


def test_chain_takes_five(spark):
    e = spark.createDataFrame([("a", "c", 1), ("a", "b", 0), ("b", "d", 0), ("c", "e", 0), ("d", "f", 0), ("d", "a", 0)], "from_id string, to_id string, rank int")
    got = graph.chain(spark.createDataFrame([("a",)], "start string"), e).orderBy("ord").collect()
    assert [r.node for r in got] == ["a", "b", "c", "d", "e"]


def test_merging_groups(spark):
    g = spark.createDataFrame([("a", ["r1", "r2"], ["t1", "t2"], []), ("b", ["r3"], ["t2"], []), ("c", ["r4"], ["t9"], ["x"])], "key string, routes array<string>, tables array<string>, roles array<string>")
    assert {r.key: r.routes for r in graph.merged_groups(g).collect()} == {"a": "r1,r2,r3", "c": "r4"}


@pytest.mark.parametrize("block", [1, 3, 7, 4096])
def test_neighbours_in_blocks_of_any_size(spark, block):
    """Against all pairs in plain Python, with ties, copies and zero vectors."""
    import random

    rng = random.Random(block)
    vs = [[rng.choice([-1.0, 0.0, 1.0]) for _ in range(3)] for _ in range(40)]
    df = vectors.indexed(spark.createDataFrame(list(enumerate(vs)), "vec_id long, embedding array<double>"), "vec_id", "embedding", 3)
    unit = {r.vec_id: r.embedding for r in df.collect()}
    score = lambda a, b: round(sum((x * y for x, y in zip(unit[a], unit[b])), 0.0), 6)
    want, near = set(), set()
    for q in range(0, 40, 5):
        order = sorted((-score(q, v), v) for v in unit)
        want |= {(q, v, rank) for rank, (_, v) in enumerate(order[:6], 1) if v != q}
        near |= {(q, v) for s, v in order if -s >= 0.5 and v != q}
    queries = df.where("vec_id % 5 = 0")
    assert {(r.query_id, r.neighbor_id, r["rank"]) for r in vectors.knn(queries, df, 6, block=block).collect()} == want
    assert {(r.query_id, r.neighbor_id) for r in vectors.similar(queries, df, 0.5, block=block).collect()} == near
    assert vectors.knn(queries.limit(0), df, 6).count() == vectors.knn(queries, df.limit(0), 6).count() == 0


def test_a_search_has_no_nested_loop(spark, sf_dir):
    from sparkloom.plans import catalog

    plan = catalog.QUERIES["knn_topk"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_first_json_by_brute_force(spark, sf_dir):
    """The first text from a brace that the standard library reads as an object."""
    import json

    from sparkloom.plans import catalog

    def first(t):
        for at, c in enumerate(t):
            if c == "{":
                try:
                    value, end = json.JSONDecoder().raw_decode(t[at:])
                except ValueError:
                    continue
                return t[at : at + end]
        return None

    got = {(r.conv_id, r.turn): r.found for r in catalog.QUERIES["first_json_object"](spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    for r in rows:
        want = first(f"{r.text} " + json.dumps({"role": r.role, "turn": r.turn}, separators=(",", ":")))
        found = got[r.conv_id, r.turn]
        assert (found and json.loads(found)) == (want and json.loads(want))


def test_clusters_cost_no_more_than_plain_rounds(spark, sf_dir):
    """K-means against plain rounds from the same centres: no further round makes it cheaper."""
    import numpy as np

    from sparkloom.plans import model

    made = vectors.kmeans(model.chunks(spark, sf_dir), "embedding", 10).select("embedding", "cluster").collect()
    x, c = np.array([r.embedding for r in made]), np.array([r.cluster for r in made])
    centres = np.array([x[c == k].mean(0) for k in range(10) if (c == k).any()])
    cost = lambda m: ((x[:, None] - m[None]) ** 2).sum(2).min(1).sum()
    own = sum(((x[c == k] - x[c == k].mean(0)) ** 2).sum() for k in set(c))
    rounds = centres
    for _ in range(20):
        near = ((x[:, None] - rounds[None]) ** 2).sum(2).argmin(1)
        rounds = np.array([x[near == k].mean(0) if (near == k).any() else rounds[k] for k in range(len(rounds))])
    assert own <= cost(rounds) * 1.03


def test_chains_by_brute_force(spark, sf_dir):
    """Breadth first from every page, by kind of edge and id, five nodes at most."""
    from sparkloom.plans import catalog

    after = {}
    for r in catalog._edges(spark, sf_dir).collect():
        after.setdefault(r.a, []).append((r.b % 3, r.b))
    got = {}
    for r in catalog.QUERIES["page_chains"](spark, sf_dir).collect():
        got.setdefault(r.start, []).append((r.ord, r.node))
    for start in after:
        taken, ways = [start], [(start, "")]
        for _ in range(4):
            best = {}
            for node, way in ways:
                for rank, b in after.get(node, []):
                    if b not in taken:
                        w = f"{way}/{rank}/{b}"
                        best[b] = min(best.get(b, w), w)
            ways = sorted(((b, w) for b, w in best.items()), key=lambda x: x[1])
            taken += [b for b, _ in ways]
        assert [n for _, n in sorted(got[start])] == taken[:5]


def test_links(spark):
    left = spark.createDataFrame([(1, "/a/x.jsp"), (2, "y.jsp"), (3, "z")], "l int, p string")
    right = spark.createDataFrame([(10, "/a/x.jsp"), (11, "/b/y.jsp")], "r int, q string")
    tiers = [("exact", lambda d: F.col("p"), lambda d: F.col("q")), ("name", lambda d: F.substring_index("p", "/", -1), lambda d: F.substring_index("q", "/", -1))]
    assert {tuple(r) for r in linking.ladder(left, right, tiers, "l", "r").collect()} == {(1, 10, "exact"), (2, 11, "name")}
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b")], "id string, ord int, v string")
    assert linking.deduplicated(df, ["id"], "ord").first()["v"] == "a" and linking.last_wins(df, ["id"], "ord").first()["v"] == "b"
    methods = spark.createDataFrame([("c", "execute"), ("c", "go"), ("d", "only"), ("e", "x"), ("e", "y")], "class_id string, method string")
    assert {tuple(r) for r in linking.chosen_method(methods, F.lit("none"), ["execute"]).collect()} == {("c", "execute"), ("d", "only")}


def test_gates(spark):
    m = spark.createDataFrame([(0.7, 0.21, None)], "parse_success double, unresolved double, cohesion double")
    rows = {r.gate: r.ok for r in gates.gate_rows(m).collect()}
    assert rows == {"parse_success": True, "unresolved": False, "cohesion": False}
    with pytest.raises(ValueError):
        gates.enforced(gates.gate_rows(m))


def test_vectors(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], "vec_id long, embedding array<double>")
    ready = vectors.indexed(df, "vec_id", "embedding", 2)
    got = vectors.knn(ready.where("vec_id = 4"), ready, 3).orderBy("rank").collect()
    assert [r.neighbor_id for r in got] == [3, 2]
    assert df.select(vectors.cosine(F.col("embedding"), F.array(F.lit(0.0), F.lit(0.0))).alias("x")).first()["x"] == 0
    texts = spark.createDataFrame([("a",), ("a",), ("b",)], "content string")
    none = spark.createDataFrame([], "key string, vector array<float>")
    made = vectors.encoded(texts, none, 8).collect()
    assert len(made) == 3 and len({tuple(r.embedding) for r in made}) == 2


def test_prompts(spark):
    df = spark.createDataFrame([("a", 'x {"k": "v"} y')], "n string, t string")
    assert df.select(prompts.formatted("<{n}>", {"n": F.col("n")}).alias("x")).first()["x"] == "<a>"
    with pytest.raises(KeyError):
        prompts.formatted("{m}", {})
    assert df.select(prompts.validated(prompts.parsed(F.col("t")), ["k"]).alias("x")).first()["x"] == '{"k": "v"}'


def tree(root, files):
    for name, body in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(body)
    return str(root)


FILES = {
    "src/a/web/Emp.java": 'package a.web;\n@Path("/employee/list")\npublic class Emp {\n @RolesAllowed("Admin") @GET public String go() { return "SELECT a FROM emp"; }\n}',
    "web/WEB-INF/web.xml": "<web-app><servlet-mapping><servlet-name>Emp</servlet-name><url-pattern>/emp/*</url-pattern></servlet-mapping></web-app>",
    "web/a.jsp": '<%@ include file="b.jsp" %>',
    "web/b.jsp": "<p>",
    "db/x.sql": "INSERT INTO emp (a) VALUES (1)\nGO\nSELECT b FROM dept",
    "target/skip.java": "class Skip {}",
}


def test_six_stages(spark, tmp_path):
    run = pipeline.Run(spark, tree(tmp_path / "p", FILES), str(tmp_path / "out"))
    pipeline.execute(run)
    assert run.table("scan", "files").count() == 5
    ids = {r.id for r in run.table("link", "relations").collect()}
    assert "rel_class_Emp->readsFrom:table_emp" in ids and "rel_jsp_a->includesView:jsp_b" in ids and "rel_class_Emp->securedBy:role_Admin" in ids
    caps = {r.domain: r for r in run.table("assemble", "capabilities").collect()}
    #: /emp and /employee share a table and a role, so they are one capability.
    assert caps["emp"].tables == ["emp"] and caps["emp"].members == 2
    texts = {r.document: r.markdown for r in run.table("render", "documents").collect()}
    assert "### emp" in texts["brd"] and "### emp" in texts["tech"]
    for r in run.table("render", "sections").collect():
        assert texts[r.document][r.start : r.end] == r.body
    assert {(r.kind, r.name) for r in run.table("extract", "declarations").collect()} >= {("class", "Emp")}
    assert {r.chunk_type for r in run.table("embed", "chunks").collect()} >= {"class", "jsp", "config"}
    assert all(r.ok for r in pipeline.measures(run).collect())
    pipeline.execute(run, "render")


def test_files(spark, tmp_path):
    root = tree(tmp_path / "p", {"src/a.java": "class A {}\n// TODO x\n", "b.md": "TODO"})
    df = source.inventory(spark, root, [".java"])
    assert [tuple(r) for r in source.grep(df, "TODO").collect()] == [("src/a.java", 1)]
    assert [tuple(r) for r in source.grep_lines(df, "TODO").collect()] == [("src/a.java", 2, "// TODO x")]
    assert source.roots(df, {"java": ["src"]}).first()["root"] == "src"
    n, sample = source.glob_sample(source.inventory(spark, root), "*.{java,md}")
    assert n.first()["n"] == 2 and sample.count() == 2


def test_stream(spark, tmp_path, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(str(tmp_path / "in"))
    stream = progress.stream_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")), F.col("event_type") == "error", late="0 seconds")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("counts").agg(F.sum("processed")).first()[0] == events.count()


def test_embedding_covers_whole_files(spark, tmp_path):
    texts = {"a.sql": "x" * 4000 + "one", "b.sql": "x" * 4000 + "two", "c.sql": "y" * 8000, "d.sql": "z"}
    run = pipeline.Run(spark, tree(tmp_path / "p", texts), str(tmp_path / "out"))
    pipeline.scan(run)
    pipeline.embed(run)
    made = run.table("embed", "chunks").collect()
    assert {r.source_path: r.content for r in made} == texts
    assert len({r.chunk_id for r in made}) == len(made) == len({r.key for r in made}) == 4 and all(r.embedding for r in made)


def folded(groups):
    """The fold in order: key, single, tables, roles."""
    kept = []
    for key, single, tables, roles in sorted(groups):
        own = (set(tables), set(roles))
        into = None
        if single:
            into = next((x for x in kept if own[0] and len(x[1] & own[0]) >= min(2, len(own[0]) * 0.5) or x[2] & own[1]), None)
        if into is None:
            kept.append([key, *own, [key]])
        else:
            into[1] |= own[0]
            into[2] |= own[1]
            into[3].append(key)
    return {k: x[0] for x in kept for k in x[3]}


@pytest.mark.parametrize("seed", range(6))
def test_merging_by_rounds_equals_the_fold(spark, seed):
    import random

    rng = random.Random(seed)
    groups = [(f"g{i:03d}", rng.random() < 0.7, [f"t{rng.randrange(25)}" for _ in range(rng.randrange(5))], [f"r{rng.randrange(30)}" for _ in range(rng.randrange(2))]) for i in range(60)]
    groups = [(k, s, sorted(set(t)), r) for k, s, t, r in groups]
    df = spark.createDataFrame(groups, "key string, single boolean, tables array<string>, roles array<string>")
    assert {r.key: r.root for r in graph.group_roots(df).collect()} == folded(groups)


def test_merging_along_a_chain(spark):
    """Each group brings the table by which the next one joins."""
    groups = [(f"g{i:02d}", i > 0, [f"t{i}", f"t{i + 1}"], None) for i in range(12)]
    df = spark.createDataFrame(groups, "key string, single boolean, tables array<string>, roles array<string>")
    assert {r.root for r in graph.group_roots(df).collect()} == {"g00"}
    assert graph.group_roots(df.limit(0)).count() == 0


def test_a_name_that_all_groups_share_costs_one_row(spark):
    """Of 2,000 groups with one table, two million pairs were made; the frontier has one row."""
    rows = spark.range(2000).select(F.format_string("g%04d", "id").alias("key"), F.lit(True).alias("single"), F.array(F.lit("t")).alias("tables"), F.array().cast("array<string>").alias("roles"))
    since = rows.select(F.lit("t").alias("name"), F.col("key").alias("since"), F.col("key").alias("root"))
    assert [tuple(r) for r in graph.frontier(since, ["name"]).collect()] == [("t", "g0000", "g0000")]
    assert {r.root for r in graph.group_roots(rows).collect()} == {"g0000"}
