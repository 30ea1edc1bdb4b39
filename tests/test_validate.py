"""Findings by language, edges of empty and broken texts, services of generic markup."""

from pyspark.sql import functions as F

from sparkloom.functions import extract, markup
from sparkloom.operators import configs, trees, validate

TEXTS = [
    ("a.java", "package a.b;\npackage c;\nimport x.y.*;\nimport bad name;\nclass A { void b( { }"),
    ("b.java", "package a-b;\n"),
    ("c.jsp", "<%@ page language=java %>\n${a <% x %> <jsp:forward page='b'>"),
    ("d.xml", "<?xml verson='1'?><a x=1><p:b></a>"),
    ("e.js", "var a = 1;"),
    ("f.sql", "select 'a; update x"),
    ("g.vbs", "Sub A\nIf b Then\nEnd Sub"),
    ("h.html", None),
    ("i.cob", "MOVE ("),
    ("j.js", "function f() { return `${(`; }"),
]


def test_findings(spark):
    files = spark.createDataFrame(TEXTS, "path string, text string").withColumn("language", validate.language_of(F.col("path")))
    got = {}
    for r in validate.findings(files).collect():
        got.setdefault(r.path, set()).add((r.validator, r.severity, r.detail))
    assert got["a.java"] == {("package_syntax", "issue", "multiple"), ("import_syntax", "issue", "import bad name;"), ("balanced_braces", "issue", "unclosed {"), ("balanced_parentheses", "issue", "unclosed (")}
    assert got["b.java"] == {("package_syntax", "issue", "invalid"), ("class_syntax", "warning", "none")}
    assert got["c.jsp"] == {("directive_syntax", "issue", "malformed <%@"), ("el_syntax", "issue", "unclosed ${"), ("tag_syntax", "issue", "unclosed <jsp:forward>")}
    assert got["d.xml"] == {("xml_declaration", "issue", "<?xml verson='1'?>"), ("balanced_tags", "issue", "unclosed <p:b>"), ("attribute_syntax", "issue", "a x"), ("namespace_syntax", "issue", "p:b p")}
    assert got["e.js"] == {("function_syntax", "warning", "no functions")}
    assert got["f.sql"] == {("string_literals", "issue", "unterminated '"), ("quoted_identifiers", "issue", "single quotes"), ("statement_syntax", "warning", "no semicolon")}
    assert got["g.vbs"] == {("end_statements", "issue", "unclosed if")}
    assert got["h.html"] == {("content", "warning", "empty")} and "i.cob" not in got and "j.js" not in got
    rows = {r.path: r for r in validate.validated(files).collect()}
    assert len(rows) == len(TEXTS) and rows["h.html"].is_valid and rows["i.cob"].is_valid and not rows["g.vbs"].is_valid and rows["h.html"].content_length == 0
    assert validate.validated(files.limit(0)).count() == 0


def test_generic_services_keep_their_own(spark):
    text = '<server><mbean name="a" code="c.A"><depends>x</depends><attribute name="k">1</attribute></mbean><mbean code="c.B"/><mbean name="d" code="c.D"><depends>y</depends></mbean><depends>stray</depends></server>'
    rows = markup.element_rows(spark.createDataFrame([("f", text), ("g", None)], "file string, text string"), "file", F.col("text"))
    assert {tuple(r) for r in configs.generic_services(rows, "file").collect()} == {("f", "a", "c.A", "x", "config_k=1"), ("f", "d", "c.D", "y", "")}


def test_property_lines_keep_digits(spark):
    df = spark.createDataFrame([("10 = 01\n2b2=b2b2\r\n# c=1\n",)], "t string").select(extract.properties(F.col("t")).alias("p"))
    assert [tuple(x) for x in df.first()["p"]] == [("10", "01"), ("2b2", "b2b2")]


def test_config_errors(spark):
    docs = [(1, "llm: {provider: openai, temperature: 1, max_tokens: 5}\nsteps: []"), (2, "llm: {provider: x, temperature: hot, max_tokens: 0}"), (3, "nonsense: [")]
    rows = trees.walked(spark.createDataFrame(docs, "id int, t string").select("id", trees.yaml_as_json(F.col("t")).alias("j")), "id", F.col("j"))
    got = {(r.id, r.field, r.message) for r in validate.config_errors(rows, "id", ("steps",)).collect()}
    assert got == {(2, "llm.provider", "unknown provider"), (2, "llm.temperature", "out of bounds"), (2, "llm.max_tokens", "out of bounds"), (2, "steps", "missing")}


def test_yaml_is_read_by_the_fast_parser_with_the_same_values(spark):
    """Documents of the fast parser, and those that it refuses, are what the library's own parser gives."""
    import json

    import yaml

    from sparkloom.operators import trees

    texts = ["a: 1", "a: [1, 'x', {b: null}]\n", "d: 2020-01-02\n1: x\n", "- &x {a: 1}\n- *x\n", "a: b: c", "\t- a", "", "é: \"\\u00e9\"\n", "a: |\n  x\n  y\n", "? [a]\n: b\n", None]

    def want(text):
        try:
            return None if text is None else json.dumps(yaml.safe_load(text), default=str, ensure_ascii=False)
        except (yaml.YAMLError, ValueError, TypeError, RecursionError):
            return None

    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", trees.yaml_as_json(F.col("t")).alias("j")).collect()
    assert {r.i: r.j for r in got} == {i: want(t) for i, t in enumerate(texts)}


def test_made_documents_are_dealt_out(spark, sf_dir):
    """One small file was one task, whatever the documents made of it cost."""
    from sparkloom.plans import catalog_checks, model

    assert catalog_checks._orders(spark, sf_dir).rdd.getNumPartitions() == 4
    assert model.dealt(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == 4


def test_xml_elements_are_read_once(spark):
    files = spark.createDataFrame([("a", "xml", "<a b=1><c:d/></a>")], "path string, language string, text string")
    from sparkloom.operators import validate

    assert validate.attributes(files)._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert {(r.validator, r.detail) for r in validate.attributes(files).collect()} == {("attribute_syntax", "a b"), ("namespace_syntax", "c:d c")}
