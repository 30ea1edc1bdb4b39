"""Queries of balance checks, element trees and nested documents, over texts made from the tables' columns and over pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.functions import markup, stacks
from sparkloom.operators import trees, validate
from sparkloom.plans import model, render
from sparkloom.plans.catalog import query

#: What is put behind a source, by key modulo their number, and its faults (kind, sign).
BROKEN = (
    ("", ()),
    ("class X { void y() { } ) }", (("unexpected", ")"),)),
    ("class X { void y( {", (("unclosed", "{"), ("unclosed", "("), ("unclosed", "{"))),
    ("class X { int[] a = { 1, (2 ]; }", (("unclosed", "{"), ("unclosed", "("), ("unexpected", "]"))),
    ('class X { String s = "abc; }', (("unclosed", "{"), ("unterminated", '"'))),
    ("/* } never closed", (("unterminated", "/*"),)),
    ("// ) ] }", ()),
)


def _broken(spark, d):
    suffix = F.element_at(F.array(*(F.lit(x) for x, _ in BROKEN)), (F.pmod("c_custkey", F.lit(len(BROKEN))) + 1).cast("int"))
    return model.sources(spark, d).select("path", F.lit("java").alias("language"), F.concat("text", suffix).alias("text"))


@query(
    f"WITH {model.SOURCES}, b(r, kind, sign) AS (VALUES " + ", ".join(f"({r}, '{k}', '{s}')" for r, (_, faults) in enumerate(BROKEN) for k, s in faults) + ") "
    f"SELECT path, kind, sign, (19 + more)::int AS line FROM src JOIN b ON r = k % {len(BROKEN)}".replace("SELECT path, kind, sign", "SELECT src.path, b.kind, b.sign").replace("r = k %", "b.r = src.k %")
)
def source_faults(spark, d):
    found = _broken(spark, d).select("path", F.explode(stacks.faults(F.col("text"), F.lit("java"))).alias("f"))
    return found.select("path", "f.kind", "f.sign", "f.line")


@query()
def page_tag_faults(spark, d):
    p = model.table(spark, d, "pages").select("page_id", F.explode(stacks.faults(F.col("html"), F.lit("html"))).alias("f"))
    return p.groupBy("page_id", "f.kind", "f.sign").agg(F.count("*").alias("n"), F.min("f.at").alias("first_at"))


#: A page with code, an expression, a directive and tags; by key modulo 5 one of them is broken.
_JSP_KINDS = (("malformed", "<%@"), ("unclosed", "<%"), ("unclosed", "${"), ("unclosed", "<jsp:include>"))


@query("WITH b(r, kind, sign) AS (VALUES " + ", ".join(f"({r + 1}, '{k}', '{s}')" for r, (k, s) in enumerate(_JSP_KINDS)) + ") SELECT o_orderkey, kind, sign FROM orders JOIN b ON r = o_orderkey % 5")
def jsp_faults(spark, d):
    o = model.table(spark, d, "orders")
    bad = lambda r, broken, whole: F.when(F.col("o_orderkey") % 5 == r, F.lit(broken)).otherwise(F.lit(whole))
    page = F.concat(
        bad(1, "<%@ page language=java %>", '<%@ page language="java" %>'),
        F.lit("\n<%-- <% ${ --%><html>${order"), F.col("o_orderkey").cast("string"), bad(3, "", "}"),
        bad(4, '<jsp:include page="a.jsp">', '<jsp:include page="a.jsp"/>'),
        F.lit("<% if (a) { %>x<% }"), bad(2, "", " %>"), F.lit("</html>"),
    )
    #: An open mark hides the text up to the next, so its order is made by itself.
    return o.select("o_orderkey", F.explode(stacks.faults(page, F.lit("jsp"))).alias("f")).select("o_orderkey", "f.kind", "f.sign")


@query("SELECT o_orderkey, 'unclosed' AS kind, CASE o_orderkey % 3 WHEN 0 THEN 'sub' ELSE 'if' END AS sign, CASE o_orderkey % 3 WHEN 0 THEN 1 ELSE 2 END::int AS line FROM orders WHERE o_orderkey % 3 <> 2")
def vb_faults(spark, d):
    o = model.table(spark, d, "orders")
    r = F.col("o_orderkey") % 3
    code = F.concat(F.lit("Sub Go"), F.col("o_orderkey").cast("string"), F.lit("(a)\nIf a > 1 Then\n  x = \"End Sub\" ' End If\n"), F.when(r == 1, "").otherwise("End If\n"), F.lit("If a Then b = 1\nFor i = 1 To 3\n Exit For\nNext\n"), F.when(r == 0, "").otherwise("End Sub\n"))
    return o.select("o_orderkey", F.explode(stacks.faults(code, F.lit("vbscript"))).alias("f")).select("o_orderkey", "f.kind", "f.sign", "f.line")


def _orders(spark, d):
    return model.dealt(model.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), "o_orderkey")


def _order_xml():
    """An order as XML: the prefix p is declared but for every fourth key."""
    key, prio = F.col("o_orderkey").cast("string"), F.substring("o_orderpriority", 1, 1)
    return F.concat(
        F.lit('<?xml version="1.0"?><!-- <x> --><o:order xmlns:o="urn:o"'), F.when(F.col("o_orderkey") % 4 != 0, ' xmlns:p="urn:p"').otherwise(""), F.lit(' id="'), key, F.lit('">'),
        F.lit("<status>"), F.col("o_orderstatus"), F.lit("</status><p:prio n='"), prio, F.lit("'/>"),
        F.array_join(F.transform(F.sequence(F.lit(1), (F.col("o_orderkey") % 3 + 1).cast("int")), lambda i: F.concat(F.lit('<lines><line no="'), i, F.lit('" q=1><![CDATA[a < b]]></line></lines>'))), ""),
        F.lit("</o:order>"),
    )


@query(
    "WITH l AS (SELECT o_orderkey, unnest(range(1, o_orderkey % 3 + 2)) AS i FROM orders) "
    "SELECT o_orderkey, 'o:order' AS path, 1 AS depth, 1::bigint AS n, CASE WHEN o_orderkey % 4 = 0 THEN 'id,xmlns:o' ELSE 'id,xmlns:o,xmlns:p' END AS attributes, '' AS texts, '' AS undeclared FROM orders "
    "UNION ALL SELECT o_orderkey, 'o:order/status', 2, 1, '', o_orderstatus, '' FROM orders "
    "UNION ALL SELECT o_orderkey, 'o:order/p:prio', 2, 1, 'n', '', CASE WHEN o_orderkey % 4 = 0 THEN 'p' ELSE '' END FROM orders "
    "UNION ALL SELECT o_orderkey, 'o:order/lines', 2, count(*), '', '', '' FROM l GROUP BY 1 "
    "UNION ALL SELECT o_orderkey, 'o:order/lines/line', 3, count(*), 'no,q', 'a b', '' FROM l GROUP BY 1"
)
def xml_elements(spark, d):
    rows = markup.element_rows(_orders(spark, d).select("o_orderkey", _order_xml().alias("x")), "o_orderkey", F.col("x"))
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))), ",")
    return rows.groupBy("o_orderkey", "path", "depth").agg(F.count("*").alias("n"), listed(F.map_keys("attributes")).alias("attributes"), F.array_join(F.array_sort(F.collect_set("text")), ",").alias("texts"), listed(F.col("undeclared")).alias("undeclared"))


@query(
    "WITH l AS (SELECT unnest(range(1, o_orderkey % 3 + 2)) AS i FROM orders) SELECT 'o:order' AS name, 'id' AS attribute, count(*) AS n FROM orders UNION ALL SELECT 'o:order', 'xmlns:o', count(*) FROM orders "
    "UNION ALL SELECT 'o:order', 'xmlns:p', count(*) FROM orders WHERE o_orderkey % 4 <> 0 UNION ALL SELECT 'p:prio', 'n', count(*) FROM orders UNION ALL SELECT 'line', 'no', count(*) FROM l UNION ALL SELECT 'line', 'q', count(*) FROM l"
)
def xml_attribute_counts(spark, d):
    return markup.attribute_counts(markup.element_rows(_orders(spark, d).select("o_orderkey", _order_xml().alias("x")), "o_orderkey", F.col("x")))


@query()
def page_elements(spark, d):
    """Elements by path over all pages."""
    rows = markup.element_rows(model.table(spark, d, "pages"), "page_id", F.col("html"), html=True)
    return rows.groupBy("path", "depth").agg(F.count("*").alias("n"), F.count_distinct("page_id").alias("pages"))


def _customer_yaml():
    key = F.col("c_custkey").cast("string")
    return F.concat(
        F.lit("# a customer\nname: c"), key, F.lit("\nsegment: "), F.col("c_mktsegment"), F.lit("\nfiles:\n"),
        F.array_join(F.transform(F.sequence(F.lit(0), (F.col("c_custkey") % 3).cast("int")), lambda i: F.concat(F.lit("  - path: "), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("'a\\b"), i, F.lit("'"))).otherwise(F.concat(F.lit("/a/b"), i)), F.lit("\n    size: "), i, F.lit("\n"))), ""),
        F.lit("deep: {a: {b: [true, null, {c: 1.5}]}}\nnone: {}\n"),
    )


_YAML = (
    "WITH f AS (SELECT c_custkey, unnest(range(0, c_custkey % 3 + 1)) AS i FROM customer), r AS ("
    "SELECT c_custkey, '' AS path, 0 AS depth, 'object' AS kind, NULL AS value FROM customer "
    "UNION ALL SELECT c_custkey, 'name', 1, 'string', 'c' || c_custkey FROM customer UNION ALL SELECT c_custkey, 'segment', 1, 'string', c_mktsegment FROM customer "
    "UNION ALL SELECT c_custkey, 'files', 1, 'array', NULL FROM customer UNION ALL SELECT c_custkey, 'files[' || i || ']', 2, 'object', NULL FROM f "
    "UNION ALL SELECT c_custkey, 'files[' || i || '].path', 3, 'string', CASE WHEN c_custkey % 2 = 0 THEN 'a\\b' ELSE '/a/b' END || i FROM f "
    "UNION ALL SELECT c_custkey, 'files[' || i || '].size', 3, 'number', i::varchar FROM f "
    "UNION ALL SELECT c_custkey, unnest(['deep', 'none', 'deep.a', 'deep.a.b', 'deep.a.b[0]', 'deep.a.b[1]', 'deep.a.b[2]', 'deep.a.b[2].c']), unnest([1, 1, 2, 3, 4, 4, 4, 5]), unnest(['object', 'object', 'object', 'array', 'boolean', 'null', 'object', 'number']), unnest([NULL, NULL, NULL, NULL, 'true', NULL, NULL, '1.5']) FROM customer)"
)


def _yaml_rows(spark, d):
    docs = model.dealt(model.table(spark, d, "customer").select("c_custkey", "c_mktsegment")).select("c_custkey", trees.yaml_as_json(_customer_yaml()).alias("j"))
    return trees.walked(docs, "c_custkey", F.col("j"))


@query(f"{_YAML} SELECT * FROM r")
def yaml_values(spark, d):
    return _yaml_rows(spark, d).drop("name")


@query("SELECT c_custkey, 5 AS max_depth FROM customer")
def yaml_depths(spark, d):
    return trees.depths(_yaml_rows(spark, d), "c_custkey")


@query(f"{_YAML} SELECT c_custkey, path, value, CASE WHEN contains(value, '\\') THEN 'windows' ELSE 'absolute' END AS violation FROM r WHERE path LIKE '%].path'")
def yaml_path_violations(spark, d):
    return trees.path_violations(_yaml_rows(spark, d), "c_custkey")


# Validators over files


#: What the stack's faults of the broken sources are called.
_ISSUES = {"{": "balanced_braces", "(": "balanced_parentheses", ")": "balanced_parentheses", "]": "balanced_brackets", '"': "string_literals", "/*": "comments"}


@query(
    f"WITH {model.SOURCES}, b(r, issue) AS (VALUES " + ", ".join(f"({r}, '{_ISSUES[s]}: {k} {s}')" for r, (_, faults) in enumerate(BROKEN) for k, s in faults) + ") "
    "SELECT src.path, count(b.r) = 0 AS is_valid, coalesce(string_agg(b.issue, '; ' ORDER BY b.issue), '') AS issues, 'class_syntax: several' AS warnings FROM src LEFT JOIN b ON b.r = src.k % " + str(len(BROKEN)) + " GROUP BY 1"
)
def validated_sources(spark, d):
    found = validate.validated(_broken(spark, d))
    return found.select("path", "is_valid", F.array_join("issues", "; ").alias("issues"), F.array_join("warnings", "; ").alias("warnings"))


@query(
    "WITH s AS (SELECT o_orderkey AS k, o_orderkey % 4 AS r FROM orders), "
    "f AS (SELECT k, unnest(CASE r WHEN 0 THEN ['quoted_identifiers: single quotes', 'statement_syntax: no semicolon', 'string_literals: unterminated ' || chr(39)] WHEN 2 THEN ['balanced_parentheses: unclosed ('] WHEN 3 THEN ['content: empty'] END) AS f FROM s) "
    "SELECT 'q' || k || '.sql' AS path, f AS finding FROM f"
)
def sql_findings(spark, d):
    o, r = model.table(spark, d, "orders"), F.col("o_orderkey") % 4
    text = F.when(r == 0, "select 'a").when(r == 1, "update t set a = 1;").when(r == 2, "select (a;").otherwise("")
    files = o.select(F.concat(F.lit("q"), "o_orderkey", F.lit(".sql")).alias("path"), text.alias("text"))
    found = validate.findings(files.withColumn("language", validate.language_of(F.col("path"))))
    return found.select("path", F.concat_ws(": ", "validator", "detail").alias("finding"))


@query(
    "SELECT o_orderkey::varchar AS path, 'attribute_syntax' AS validator, 'line q' AS detail, o_orderkey % 3 + 1 AS n FROM orders "
    "UNION ALL SELECT o_orderkey::varchar, 'namespace_syntax', 'p:prio p', 1 FROM orders WHERE o_orderkey % 4 = 0"
)
def xml_findings(spark, d):
    files = _orders(spark, d).select(F.col("o_orderkey").cast("string").alias("path"), F.lit("xml").alias("language"), _order_xml().alias("text"))
    return validate.findings(files).groupBy("path", "validator", "detail").agg(F.count("*").alias("n"))


@query(
    "WITH c AS (SELECT c_custkey, c_custkey % 5 AS r FROM customer) SELECT c_custkey, 'llm.temperature' AS field, 'out of bounds' AS message, '3' AS value FROM c WHERE r = 1 "
    "UNION ALL SELECT c_custkey, 'llm.max_tokens', 'out of bounds', '0' FROM c WHERE r = 2 UNION ALL SELECT c_custkey, 'llm.provider', 'unknown provider', 'none' FROM c WHERE r = 3 UNION ALL SELECT c_custkey, 'steps', 'missing', NULL FROM c WHERE r = 4"
)
def config_findings(spark, d):
    """Configurations, one a customer, of which four in five have an error each."""
    c, r = model.dealt(model.table(spark, d, "customer").select("c_custkey")), F.col("c_custkey") % 5
    pick = lambda at, bad, good: F.when(r == at, bad).otherwise(good)
    text = F.concat(F.lit("llm:\n  provider: "), pick(3, "none", "openai"), F.lit("\n  temperature: "), pick(1, "3", "0.5"), F.lit("\n  max_tokens: "), pick(2, "0", "100"), F.lit("\n"), pick(4, "", "steps: [a]\n"))
    rows = trees.walked(c.select("c_custkey", trees.yaml_as_json(text).alias("j")), "c_custkey", F.col("j"))
    return validate.config_errors(rows, "c_custkey", ("steps", "llm"))


# Documents: customers as capabilities, segments as domains


def _capabilities(spark, d):
    c, key = model.table(spark, d, "customer"), F.col("c_custkey")
    odd = key % 2 == 1
    return c.select(
        F.lpad(key.cast("string"), 9, "0").alias("id"),
        F.concat(F.lit("orderDesk"), key).alias("name"),
        F.concat(F.lit(" Serves nation "), "c_nationkey", F.lit(" ")).alias("purpose"),
        F.when(odd, F.concat(F.lit("Menu"), key % 3)).alias("menu"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("domain"),
        F.when(key % 3 == 0, "Sub").alias("subdomain"),
        F.when(odd, "UI").alias("layer"),
        F.array(F.lit("b"), F.lit(" a "), F.lit("b"), F.lit("")).alias("screens"),
        F.array().cast("array<string>").alias("handlers"),
        F.array(F.concat(F.lit("t"), key % 4)).alias("tables"),
        F.lit(None).cast("array<string>").alias("procedures"),
        (key % 7).alias("citations"),
        F.when(~odd, "sure").alias("rationale"),
    )


_DOCUMENTS = """WITH c AS (SELECT lpad(c_custkey::varchar, 9, '0') AS id, 'orderDesk' || c_custkey AS name, 'Order Desk' || c_custkey AS shown, 'Serves nation ' || c_nationkey AS purpose,
  CASE WHEN c_custkey % 2 = 1 THEN ' (Menu: Menu' || c_custkey % 3 || ')' ELSE '' END AS menu, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Unclassified' ELSE c_mktsegment END AS domain,
  CASE WHEN c_custkey % 3 = 0 THEN 'Sub' END AS subdomain, CASE WHEN c_custkey % 2 = 1 THEN 'UI' END AS layer, 't' || c_custkey % 4 AS tables,
  '- orderDesk' || c_custkey || ' — Evidence: ' || c_custkey % 7 || ' citations' || CASE WHEN c_custkey % 2 = 0 THEN ' — Rationale: sure' ELSE '' END AS detail FROM customer),
b AS (SELECT domain, count(*) AS n, '### ' || domain || chr(10) || chr(10) || '| Capability | Business Purpose |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || shown || menu || ' | ' || purpose || ' |', chr(10) ORDER BY id) AS body FROM c GROUP BY domain),
t AS (SELECT domain, subdomain, layer, count(*) AS n, '### ' || domain || coalesce('/ ' || subdomain, '') || coalesce(' — ' || layer, '') || chr(10) || chr(10) || '| Capability | Screens | Handlers | Tables | Procedures |' || chr(10) || '| --- | --- | --- | --- | --- |' || chr(10)
  || string_agg('| ' || name || ' | a, b | - | ' || tables || ' | - |', chr(10) ORDER BY id) || chr(10) || chr(10) || string_agg(detail, chr(10) || chr(10) ORDER BY id) AS body FROM c GROUP BY domain, subdomain, layer),
p AS (SELECT 'brd' AS document, 0 AS part, NULL AS domain, NULL AS subdomain, NULL AS layer, NULL AS title, NULL AS summary, '# Shop — Business Requirements Document' AS body
  UNION ALL SELECT 'brd', 1, NULL, NULL, NULL, NULL, NULL, 'Business-focused view of capabilities grouped by domain.'
  UNION ALL SELECT 'brd', 2, NULL, NULL, NULL, NULL, NULL, '## Domains' || chr(10) || chr(10) || string_agg('- ' || domain || ': ' || n || ' capabilities', chr(10) ORDER BY domain) FROM b
  UNION ALL SELECT 'brd', 3, domain, NULL, NULL, domain, n || ' capabilities', body FROM b
  UNION ALL SELECT 'tech', 0, NULL, NULL, NULL, NULL, NULL, '# Shop — Technical Specification'
  UNION ALL SELECT 'tech', 1, NULL, NULL, NULL, NULL, NULL, 'Generated from the capability graph with citations and provenance.'
  UNION ALL SELECT 'tech', 3, domain, subdomain, layer, domain || coalesce(' / ' || subdomain, '') || coalesce(' — ' || layer, ''), n || ' capabilities', body FROM t),
o AS (SELECT *, row_number() OVER w AS ord, coalesce(sum(length(body) + 2) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS start FROM p WINDOW w AS (PARTITION BY document ORDER BY part, domain, coalesce(subdomain, ''), coalesce(layer, '')))"""


@query(f"{_DOCUMENTS} SELECT document, ord, domain, subdomain, layer, title, summary, md5(body) AS body, start, start + length(body) AS \"end\" FROM o")
def document_parts(spark, d):
    return render.bundle(_capabilities(spark, d), "Shop").drop("capabilities").withColumn("body", F.md5("body"))


@query(f"{_DOCUMENTS} SELECT document, length(string_agg(body, chr(10) || chr(10) ORDER BY ord)) AS n, md5(string_agg(body, chr(10) || chr(10) ORDER BY ord)) AS markdown FROM o GROUP BY document")
def document_texts(spark, d):
    return render.bundle_texts(render.bundle(_capabilities(spark, d), "Shop")).select("document", F.length("markdown").cast("bigint").alias("n"), F.md5("markdown").alias("markdown"))
