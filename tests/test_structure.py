"""Scans, stacks and trees against plain brute force; layers and edges on small tables."""

import json
import random
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import markup, scan, stacks
from sparkloom.operators import chunks, layers, structure, trees
from sparkloom.sources import shared

CODE = '''package com.acme.app.service;
import java.util.*;
/* class Fake { } */
@Service("x")
public final class Order<T extends Base> extends Root<T> implements Runnable, Map.Entry<K, V> {
    private static final Map<String, List<Integer>> CACHE = new HashMap<>(); // } {
    @Autowired(required = false) protected OrderManager manager;
    int[] a = {1, 2}, b;
    private Runnable r = new Runnable() { public void run() { manager.tick(); } };
    static { CACHE.clear(); }
    public Order(final OrderManager m, @Named("{") String s) throws X { this.manager = m; }
    @Override
    public <R> List<R> go(String a, Map<String, R> b) {
        StockManager sm = StockManager.getInstance();
        if (a.equals("}")) { for (int i = 0; i < 3; i++) { sm.load(i); } }
        helper.find(b); go2();
        String manager = ""; manager.trim();
        run("SELECT x FROM stock", "{call pack.proc(?)}");
        return null;
    }
    abstract void nothing() throws Y;
    static OrderManager createOrder() { return null; }
    enum Kind { A(1), B { int v() { return 2; } }; int z; Kind() {} int v() { return 1; } }
    interface Inner { String name(); default int k() { return 1; } }
    class Deep { class Deeper { long q; void z() { manager.deep(); } } }
}
@interface Mark { String value() default "a;b"; }
'''


@pytest.fixture(scope="module")
def code(spark):
    return spark.createDataFrame([("A.java", CODE), ("B.java", None), ("C.java", ""), ("D.java", "class A { void b( { ) } } } class B { int c;"), ("E.java", "class A { String s = \"{ ; int x;")], "path string, text string")


def test_members_stand_under_their_own_type(code):
    d = structure.declarations(code).where("path = 'A.java'").collect()
    assert {(r.kind, r.name, r.type_name) for r in d} == {
        *(("class", n, t) for n, t in (("Order", "Order"), ("Deep", "Order.Deep"), ("Deeper", "Order.Deep.Deeper"))),
        *(("field", n, "Order") for n in ("CACHE", "manager", "a", "r")),
        *(("method", n, "Order") for n in ("go", "nothing", "createOrder")),
        ("constructor", "Order", "Order"),
        ("anonymous", "Runnable$anonymous", "Order.Runnable$anonymous"),
        ("method", "run", "Order.Runnable$anonymous"),
        ("enum", "Kind", "Order.Kind"),
        ("field", "z", "Order.Kind"),
        ("constructor", "Kind", "Order.Kind"),
        ("method", "v", "Order.Kind"),
        ("interface", "Inner", "Order.Inner"),
        ("method", "name", "Order.Inner"),
        ("method", "k", "Order.Inner"),
        ("field", "q", "Order.Deep.Deeper"),
        ("method", "z", "Order.Deep.Deeper"),
        ("annotation", "Mark", "Mark"),
        ("method", "value", "Mark"),
    }
    by = {(r.kind, r.name): r for r in d}
    order, go = by["class", "Order"], by["method", "go"]
    assert (order.package, order.extends, order.implements, order.annotations, order.modifiers) == ("com.acme.app.service", "Root<T>", ["Runnable", "Map.Entry<K, V>"], ["Service"], ["public", "final"])
    assert (order.start_line, order.end_line) == (4, 26) and (go.start_line, go.end_line) == (12, 20)
    assert go.value_type == "List<R>" and [tuple(p) for p in go.parameters] == [("String", "a"), ("Map<String, R>", "b")] and go.annotations == ["Override"]
    assert [tuple(p) for p in by["constructor", "Order"].parameters] == [("OrderManager", "m"), ("String", "s")]
    assert not by["method", "nothing"].has_body and by["method", "nothing"].complexity == 1 and by["field", "manager"].annotations == ["Autowired"]


def test_broken_code_has_rows(code):
    d = {(r.path, r.kind, r.name, r.type_name) for r in structure.declarations(code).where("path != 'A.java'").collect()}
    assert ("D.java", "class", "A", "A") in d and ("D.java", "class", "B", "B") in d and ("D.java", "field", "c", "B") in d
    assert ("E.java", "class", "A", "A") in d and not [x for x in d if x[0] in ("B.java", "C.java")]


def test_receivers_get_their_declared_types(code):
    got = {(r.receiver, r.name, r.target_type, r.via) for r in structure.resolved_calls(code).where("path = 'A.java'").collect()}
    assert {
        ("manager", "tick", "OrderManager", "field"),
        ("StockManager", "getInstance", "StockManager", "static"),
        ("a", "equals", "String", "parameter"),
        ("sm", "load", "StockManager", "local"),
        ("helper", "find", None, "unknown"),
        ("", "go2", "Order", "own"),
        ("manager", "trim", "String", "local"),
        ("manager", "deep", "OrderManager", "field"),
        ("CACHE", "clear", "Map", "field"),
    } <= got
    o = {r.type_name: r for r in structure.orchestration(code, ["*Manager"]).collect()}
    assert o["Order"].is_orchestrator and (o["Order"].manager_fields, o["Order"].unique_managers) == (1, 2) and not o["Order.Deep.Deeper"].is_orchestrator
    e = {(r.mapping_type, r.from_reference, r.to_reference) for r in structure.edges(code, ["*Manager", "create*"]).collect()}
    own = "com.acme.app.service.Order"
    assert {("sql_table_access", f"{own}.go", "stock"), ("stored_procedure_call", f"{own}.go", "pack.proc"), ("factory_method", f"{own}.createOrder", "OrderManager"), ("service_dependency", own, "StockManager.load"), ("orchestration", own, "ORCHESTRATION_PATTERN")} <= e


def test_patterns(spark):
    cases = [("OrderMgrObject", "*Mgr*", True), ("xManager", "*Manager", True), ("Managers", "*Manager", False), ("create", "create*", True), ("static aMgrObject()", "static.*MgrObject", True), ("A", "A", True), ("AB", "A", False)]
    df = spark.createDataFrame(cases, "t string, p string, want boolean")
    assert all(r.got == r.want for r in df.select("want", structure.matches(F.col("t"), F.col("p")).alias("got")).collect())


def blocks_plainly(text):
    """(open, close) of braces by one pass, strings and comments left out."""
    code, found, stack = scan.masked(text), [], []
    for at, c in enumerate(code):
        if c == "{":
            stack.append(at)
        elif c == "}" and stack:
            found.append((stack.pop(), at))
    return sorted(found + [(at, len(code)) for at in stack])


@pytest.mark.parametrize("seed", range(40))
def test_intervals_of_random_code(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["{", "}", "{", "}", "class A ", "x;", "(", ")", '"{"', "// }\n", "/* { */", "new B() ", "= ", "a.b()", "\n", "'}'"]) for _ in range(60))
    items = scan.blocks(scan.masked(text))
    assert sorted((i[1], i[2]) for i in items if i[1] >= 0) == blocks_plainly(text)
    for i in items:
        if i[3] >= 0:
            assert items[i[3]][1] < i[0] <= i[2] <= items[i[3]][2]
    block = scan.innermost(items)
    for at in range(len(text)):
        inside = [k for k, i in enumerate(items) if i[1] >= 0 and i[1] <= at <= i[2]]
        assert block(at) == (max(inside, key=lambda k: items[k][1]) if inside else -1)


def faults_plainly(text):
    """Repeatedly take out the pairs that stand next to each other; what a bracket string leaves has no pair."""
    left = [(at, c) for at, c in enumerate(text) if c in "(){}[]"]
    while True:
        for k in range(len(left) - 1):
            if stacks.PAIRS.get(left[k + 1][1]) == left[k][1]:
                del left[k : k + 2]
                break
        else:
            return left


@pytest.mark.parametrize("seed", range(60))
def test_brackets_against_reduction(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice("(){}[]a ") for _ in range(rng.randrange(30)))
    got = stacks.found(text, "java")
    left = faults_plainly(text)
    assert bool(got) == bool(left)
    #: A closing bracket is unexpected only if nothing open fits it; all unclosed ones are opening brackets of the text.
    for at, _, kind, sign in got:
        assert text[at] == sign and (sign in stacks.PAIRS) == (kind == "unexpected")
    counts = {c: text.count(c) - sum(f[3] == c for f in got) for c in "(){}[]"}
    assert all(counts[c] == counts[o] for c, o in stacks.PAIRS.items())
    assert got == sorted(got) and stacks.found(f'"{text}" /*{text}*/ // {text}', "java") == []


def test_faults_by_language():
    kinds = lambda t, k: [(f[1], f[2], f[3]) for f in stacks.found(t, k)]
    assert kinds("a\n(/* x", "java") == [(2, "unclosed", "("), (2, "unterminated", "/*")]
    assert kinds("s = 'it\nx", "java") == [(1, "unterminated", "'")]
    assert kinds("select 'it''s (' -- )\nfrom (t", "sql") == [(2, "unclosed", "(")]
    assert kinds("select 'x", "sql") == [(1, "unterminated", "'")]
    assert kinds("`${ ) }` function f(a, (b)) { } function g { } x.function(", "javascript") == [(1, "malformed", "function"), (1, "unclosed", "(")]
    assert kinds("<a><b></a><c/></d><e x='>'></e><f", "xml") == [(1, "unclosed", "<b>"), (1, "unexpected", "</d>"), (1, "malformed", "<f")]
    assert kinds("<P><br><script>if (a</b) {}</script></p>", "html") == []
    assert kinds("<% a <%-- %> --%> %> ${x} <jsp:a/> <jsp:b> </jsp:b> <%@ page a='b' %> } ", "jsp") == []
    assert kinds("<jsp:c x='1' <a> %> ${", "jsp") == [(1, "malformed", "<jsp:c"), (1, "unexpected", "%>"), (1, "unclosed", "${")]
    assert kinds("Function F(a)\nSelect Case a\nEnd Function\nWend: Do\nLoop", "vbscript") == [(2, "unclosed", "select"), (4, "unexpected", "Wend")]
    assert stacks.found(None, "java") == [] and stacks.found("(", "cobol") == []


class Tree(HTMLParser):
    """Paths of elements, by the parser of the standard library."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.paths = [], []

    def handle_starttag(self, tag, attrs):
        self.paths.append("/".join([*self.stack, tag]))
        if tag not in stacks.VOID:
            self.stack.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.paths.append("/".join([*self.stack, tag]))

    def handle_endtag(self, tag):
        if tag in self.stack:
            while self.stack.pop() != tag:
                pass


def test_page_elements_against_the_standard_parser(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html")
    rows = markup.element_rows(pages, "page_id", F.col("html"), html=True).orderBy("page_id", "ord").collect()
    found = {}
    for r in rows:
        found.setdefault(r.page_id, []).append(r.path)
    for p in pages.collect():
        tree = Tree()
        tree.feed(p.html)
        assert found.get(p.page_id, []) == tree.paths


def test_page_faults_against_the_standard_parser(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html").collect()
    for p in pages:
        tree, unclosed, unexpected = Tree(), [], []

        def end(tag, tree=tree, unclosed=unclosed, unexpected=unexpected):
            if tag not in tree.stack:
                if tag not in stacks.VOID:
                    unexpected.append(tag)
                return
            while (own := tree.stack.pop()) != tag:
                unclosed.append(own)

        tree.handle_endtag = end
        tree.feed(p.html)
        got = stacks.found(p.html, "html")
        assert sorted(f[3].strip("</>") for f in got if f[2] == "unclosed") == sorted(unclosed + tree.stack)
        assert sorted(f[3].strip("</>") for f in got if f[2] == "unexpected") == sorted(unexpected)


def test_namespaces_and_text():
    rows = markup.elements('<a xmlns:x="u"><x:b y:c="1" xml:lang="e">t <c>u</c> v</x:b><x:d/></a><x:e/>')
    assert [(r[3], r[7]) for r in rows] == [("a", []), ("a/x:b", ["y"]), ("a/x:b/c", []), ("a/x:d", []), ("x:e", ["x"])]
    assert [r[8] for r in rows] == ["", "t", "u", "", ""] and markup.elements(None) == []


def values(v, path="", depth=0):
    yield path, depth, type(v).__name__
    if isinstance(v, dict):
        for k, x in v.items():
            yield from values(x, f"{path}.{k}" if path else k, depth + 1)
    elif isinstance(v, list):
        for k, x in enumerate(v):
            yield from values(x, f"{path}[{k}]", depth + 1)


def test_walks_of_random_documents(spark):
    rng = random.Random(8)

    def made(depth):
        kind = rng.randrange(6 if depth else 2)
        if kind < 2 and depth < 5:
            return {f"k{i}": made(depth + 1) for i in range(rng.randrange(4))} if kind else [made(depth + 1) for _ in range(rng.randrange(4))]
        return rng.choice([1, 2.5, "x", True, None, ""])

    docs = [(i, json.dumps(made(0))) for i in range(25)] + [(98, "{"), (99, None)]
    kinds = {"dict": "object", "list": "array", "str": "string", "int": "number", "float": "number", "bool": "boolean", "NoneType": "null"}
    rows = trees.walked(spark.createDataFrame(docs, "id long, j string"), "id", F.col("j"))
    got = sorted((r.id, r.path, r.depth, r.kind) for r in rows.collect())
    assert got == sorted((i, p, d, kinds[k]) for i, j in docs[:25] for p, d, k in values(json.loads(j)))
    y = spark.createDataFrame([("a: [1, {b: 2}]",), ("a: [",), (None,)], "t string").select(trees.yaml_as_json(F.col("t")).alias("j"))
    assert [r.j for r in y.collect()] == ['{"a": [1, {"b": 2}]}', None, None]


def test_layers_take_the_first_rule(spark):
    rules = spark.createDataFrame([(2, "B", "**.dao.**"), (1, "A", "com.**.x*"), (3, "C", "*"), (0, "Z", "zz")], "ord int, layer string, pattern string")
    values_ = ["com.a.dao.b", "com.q.xy", "q.dao.r", "", None, "Com.A.DAO.B", "zz", "q"]
    got = {r.value: (r.layer, r.pattern) for r in layers.matched(spark.createDataFrame([(v,) for v in values_] * 2, "v string"), "v", rules).collect()}
    assert got == {"com.a.dao.b": ("B", "**.dao.**"), "com.q.xy": ("A", "com.**.x*"), "q.dao.r": ("B", "**.dao.**"), "": ("Other", None), None: ("Other", None), "Com.A.DAO.B": ("B", "**.dao.**"), "zz": ("Z", "zz"), "q": ("C", "*")}


def test_layers_against_every_rule(spark):
    rng = random.Random(3)
    part = lambda: rng.choice(["com", "acme", "service", "dao", "web", "x", "controller"])
    rules = [(k, f"L{k % 5}", ".".join(rng.choice(["**", "*", part(), part() + "*"]) for _ in range(rng.randrange(1, 4)))) for k in range(60)]
    values_ = [".".join(part() for _ in range(rng.randrange(1, 5))) for _ in range(80)]
    got = {r.value: r.layer for r in layers.matched(spark.createDataFrame([(v,) for v in values_], "v string"), "v", spark.createDataFrame(rules, "ord int, layer string, pattern string")).collect()}
    for v in values_:
        first = next((layer for _, layer, p in rules if re.search(p.replace("**", "\0").replace("*", "[^.]*").replace("\0", ".*"), v, re.I)), "Other")
        assert got[v] == first, v


def test_layers_of_code(spark):
    files = [("a", "@Path('x') class MyReportX { }"), ("b", "@Path('x') class B { }"), ("c", "class C { Servlet s; }"), ("d", "class D { }")]
    df = spark.createDataFrame(files, "path string, text string")
    none = spark.createDataFrame([], "ord int, layer string, pattern string")
    signs = spark.createDataFrame([(0, "UI", "Servlet"), (1, "Reporting", "*report*")], "ord int, layer string, sign string")
    got = {r.path: (r.layer, r.by) for r in layers.detected(df, structure.declarations(df), none, signs, {"@Path": "Integration"}).collect()}
    assert got == {"a": ("Reporting", "code"), "b": ("Integration", "framework"), "c": ("UI", "code"), "d": ("Other", "none")}


def test_edge_filter(spark):
    refs = ["com.a.B.go", "com.ab.C.x", "B.go", "x", "com.z.low.go", "com.a.b.C.D.e", None]
    e = spark.createDataFrame([(r, p) for r in refs for p in ("com.a", None)], "to_reference string, package string")
    t = {r.to_reference: r.t for r in e.select("to_reference", layers.target_package(F.col("to_reference")).alias("t")).collect()}
    assert t == {"com.a.B.go": "com.a", "com.ab.C.x": "com.ab", "B.go": "", "x": "", "com.z.low.go": "com.z", "com.a.b.C.D.e": "com.a.b.C", None: None if t[None] is None else ""}
    listed = spark.createDataFrame([("com.a",), ("com.a.b",), (None,)], "prefix string")
    got = {(r.to_reference, r.package, r.prefix) for r in layers.filtered(e, listed, exclude_same=True).collect()}
    assert got == {("com.a.B.go", None, "com.a"), ("com.ab.C.x", None, "com.a"), ("com.ab.C.x", "com.a", "com.a"), ("com.a.b.C.D.e", None, "com.a.b"), ("com.a.b.C.D.e", "com.a", "com.a.b")}
    assert layers.filtered(e, None, exclude_same=True).count() == 13


def test_chunks_of_all_kinds(spark, code):
    more = [("p.jsp", "jsp", "web", '<form name="f"><input type="text" name="n"><button type="submit" name="b"></form><% x(); %><p>'), ("c.xml", "xml", "config", "<a/>"), ("n.sql", "sql", "sql", "select 1" * 3000), ("e.sql", "sql", "sql", None)]
    files = code.selectExpr("path", "'java' AS language", "'source' AS type", "text").unionByName(spark.createDataFrame(more, "path string, language string, type string, text string"))
    got = chunks.chunks(files, ["path", "language"]).collect()
    by = {}
    for r in got:
        by.setdefault(r.source_path, []).append(r)
    assert by["p.jsp"][0].content == "jsp page form f field text n button submit b element p embedded java blocks" and by["p.jsp"][0].metadata["forms_count"] == "1"
    assert by["c.xml"][0].content == "Configuration file: c.xml" and len(by["n.sql"][0].content) == 24000 and by["e.sql"][0].content == ""
    assert {r.chunk_type for r in by["A.java"]} == {"class", "method"} and len({r.chunk_id for r in got}) == len(got)
    go = next(r for r in by["A.java"] if r.metadata.get("method_name") == "go")
    assert go.metadata["has_sql"] == "true" and go.metadata["stored_procedure_names"] == "pack.proc" and go.metadata["file_language"] == "java"
    assert all(r.metadata["file_path"] == r.source_path for r in got)


def test_a_cluster_has_to_name_its_folder(spark):
    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        def __init__(self, master):
            self.master = master
            self._jsc = type("J", (), {"sc": lambda s: type("S", (), {"getCheckpointDir": lambda s: type("O", (), {"isEmpty": lambda s: True})()})()})()

        def getConf(self):
            return Conf()

    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared.checkpoint_dir(type("Session", (), {"sparkContext": Context(master)})())


def test_files_are_never_broadcast_nor_joined(spark, code):
    """Sizes of made texts are guessed far too small, so a join with the files was planned as a broadcast of all of them."""
    plan = lambda df: df._jdf.queryExecution().toString()
    files = code.select("path", "text", F.lit("java").alias("language"), F.lit("source").alias("type"))
    for df in (structure.resolved_calls(code), structure.orchestration(code, ["*Manager"]), structure.edges(code, ["*Manager"]), chunks.chunks(files, ["path", "language"])):
        assert "Broadcast" not in plan(df) and "Join" not in plan(df)
