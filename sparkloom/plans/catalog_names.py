"""Queries of names, paths, classes and scores, over texts made from the tables' columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.functions import classify, extract, paths, scoring, text
from sparkloom.operators import aggregate, linking
from sparkloom.plans import model
from sparkloom.plans.catalog import query


def _pick(key: str, values) -> tuple:
    """One of the values by key: as a column and as SQL."""
    n = len(values)
    column = F.element_at(F.array(*map(F.lit, values)), (F.pmod(F.col(key), F.lit(n)) + 1).cast("int"))
    listed = ", ".join("'{}'".format(v.replace("'", "''")) for v in values)
    return column, f"[{listed}][{key} % {n} + 1]"


def _sql(key: str, values) -> str:
    listed = ", ".join("'{}'".format(v.replace("'", "''")) if v is not None else "NULL" for v in values)
    return f"[{listed}][{key} % {len(values)} + 1]"


FILES = ("a/B.java", "a/p.jsp", "a/t.HTML", "x.js", "s.css", "c.xml", "d.properties", "e.yml", "q.sql", "tags.tld", "run.vbs", "README", "tests/x/FooTest.java", "pom.xml", "mybuild.xml", "applicationContext-1.xml")


@query(
    "SELECT p_partkey, "
    + _sql("p_partkey", ("source", "web", "web", "script", "style", "config", "config", "config", "database", "descriptor", "other", "other", "source", "config", "config", "config"))
    + " AS file_type, "
    + _sql("p_partkey", ("java", "jsp", "html", "javascript", "css", "xml", "properties", "yaml", "sql", "tld", "vbscript", "other", "java", "xml", "xml", "xml"))
    + " AS language, p_partkey % 16 IN (13, 14) AS is_build, p_partkey % 16 = 12 AS is_test, p_partkey % 16 IN (5, 6, 7, 13, 14, 15) AS is_config FROM part"
)
def class_of_files(spark, d):
    path = F.concat(F.lit("p"), "p_partkey", F.lit("/"), _pick("p_partkey", FILES)[0])
    p = model.table(spark, d, "part").select("p_partkey", path.alias("path"))
    ext = paths.extension(F.col("path"))
    kind, language = classify.file_type(ext), classify.language_of(ext)
    return p.select("p_partkey", kind.alias("file_type"), language.alias("language"), classify.is_build_file(paths.filename(F.col("path"))).alias("is_build"), classify.is_test(F.col("path")).alias("is_test"), classify.is_config(kind, language, F.col("path")).alias("is_config"))


@query("SELECT s_suppkey, 'a/c' || s_suppkey || '.jsp' AS up, 'x' || s_suppkey || '.jsp' AS root, 'a/b/y.jsp' AS same FROM supplier")
def name_resolved_targets(spark, d):
    k = F.col("s_suppkey").cast("string")
    s = model.table(spark, d, "supplier").withColumn("own", F.concat(F.lit("a/b/p"), k, F.lit(".jsp")))
    found = lambda raw: paths.resolved_target(F.col("own"), raw)
    return s.select("s_suppkey", found(F.concat(F.lit(" ../c"), k, F.lit(".jsp?x=1"))).alias("up"), found(F.concat(F.lit("/x"), k, F.lit(".jsp"))).alias("root"), found(F.lit("./y.jsp#z")).alias("same"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'shop' || s_suppkey END AS database, 'n' || s_suppkey || '.T' AS qualified, 'p.T' AS by_package FROM supplier")
def name_databases(spark, d):
    k = F.col("s_suppkey").cast("string")
    path = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("x\\DB/shop"), k, F.lit("/t.sql"))).otherwise(F.concat(F.lit("x/dbs/shop"), k, F.lit("/t.sql")))
    return model.table(spark, d, "supplier").select("s_suppkey", paths.logical_database(path).alias("database"), paths.qualified_name(F.concat(F.lit("n"), k), F.lit("p"), F.lit("T")).alias("qualified"), paths.qualified_name(F.lit(None).cast("string"), F.lit("p"), F.lit("T")).alias("by_package"))


ROLES = ("Admin", "level3", "MANAGER", "Clerk")


@query("SELECT c_custkey, 'A' || c_custkey || ',B,C' AS roles, " + _sql("c_custkey", ("named", "level", "constant", "named")) + " AS category FROM customer")
def name_roles_in_expressions(spark, d):
    k = F.col("c_custkey").cast("string")
    expr = F.concat(F.lit("hasAnyRole('C', \"B\") and isUserInRole(\"B\") or hasRole( 'A"), k, F.lit("')"))
    return model.table(spark, d, "customer").select("c_custkey", F.array_join(text.roles_in_expression(expr), ",").alias("roles"), text.role_category(_pick("c_custkey", ROLES)[0]).alias("category"))


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN 'doc_' || doc_id || '.txt' WHEN source = 'src1' THEN lang ELSE 'doc_' || doc_id || '.txt' END AS component, source || '.' || lang AS package, CASE WHEN lang = 'en' THEN source ELSE lang END AS meaningful FROM documents")
def name_components(spark, d):
    f = model.files(spark, d)
    parts = F.split("path", "/")
    return f.select("doc_id", paths.component_after(parts, "**/en/src1/*").alias("component"), paths.package_name(F.col("path")).alias("package"), paths.last_meaningful(F.slice(parts, 1, 2), ["en"]).alias("meaningful"))


@query("SELECT doc_id, unnest([source, source || '/' || lang, source || '/' || lang || '/doc_' || doc_id || '.txt']) AS prefix, unnest([1, 2, 3]) AS depth FROM documents")
def path_prefix_rows(spark, d):
    f = model.files(spark, d).select("doc_id", F.explode(paths.path_prefixes(F.col("path"))).alias("prefix"))
    return f.select("doc_id", "prefix", F.size(F.split("prefix", "/")).alias("depth"))


KINDS = ("https://x/y", "/a/b.jsp", "/a/b.html", "/a/b", "plain")


@query("SELECT p_partkey, " + _sql("p_partkey", ("url", "page", "html", "path", "string")) + " AS by_value, 'own' AS given FROM part")
def class_of_components(spark, d):
    v = _pick("p_partkey", KINDS)[0]
    return model.table(spark, d, "part").select("p_partkey", classify.component_type(F.lit(" "), v).alias("by_value"), classify.component_type(F.lit(" own "), v).alias("given"))


@query(
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'first.T' || o_orderkey WHEN o_orderkey % 3 = 1 THEN 'local.T' || o_orderkey % 30 WHEN o_orderkey % 2 = 0 THEN 'java.lang.String' ELSE 'Unknown' END AS fqn FROM orders"
)
def class_resolved_types(spark, d):
    """Explicit import, then a local class, then a built-in one, else the name."""
    o, k = model.table(spark, d, "orders"), F.col("o_orderkey")
    name = F.when(k % 3 == 0, F.concat(F.lit("T"), k)).when(k % 3 == 1, F.concat(F.lit("L"), k % 30)).when(k % 2 == 0, "String").otherwise("Unknown")
    uses = o.select(k.cast("string").alias("file"), name.alias("name"))
    imports = o.where("o_orderkey % 3 = 0").select(k.cast("string").alias("file"), F.concat(F.lit("T"), k).alias("name"), F.explode(F.array(F.concat(F.lit("first.T"), k), F.concat(F.lit("second.T"), k))).alias("fqn"))
    local = spark.range(30).select(F.concat(F.lit("L"), "id").alias("name"), F.concat(F.lit("local.T"), "id").alias("fqn"))
    return linking.resolved_types(uses, imports, local, {"String": "java.lang.String"}).select(F.col("file").cast("bigint").alias("o_orderkey"), "fqn")


@query(
    "SELECT p_partkey, round(least(0.9, 0.6 + CASE WHEN p_size > 3 THEN 0.2 ELSE 0 END + CASE WHEN p_size % 3 > 1 THEN 0.1 ELSE 0 END + CASE WHEN p_size % 2 > 0 THEN 0.1 ELSE 0 END)::double, 4) AS subdomain, "
    "round(greatest(0.0, least(1.0, 0.6 * (p_size / 50.0) + 0.3 * CASE WHEN p_size % 2 = 0 THEN 1.0 ELSE 0.5 END + 0.1 * (p_size % 5 / 4.0)))::double, 3) AS provenance FROM part"
)
def score_confidences(spark, d):
    size = F.col("p_size").cast("double")
    p = model.table(spark, d, "part")
    return p.select("p_partkey", F.round(scoring.subdomain_confidence(F.col("p_size"), F.col("p_size") % 3, F.col("p_size") % 2), 4).alias("subdomain"), F.round(scoring.provenance_confidence(size / 50.0, F.col("p_size") % 2 == 0, (F.col("p_size") % 5) / 4.0), 3).alias("provenance"))


BODIES = ("return 1;", "if (a) { b(); } else { c(); }", "for (;;) { while (x) { } } catch (E e) { throw e; }", "int y = a ? b : c;", "switch (a) { case 1: case 2: break; }")


@query("SELECT p_partkey, " + f"[1, 2, 5, 2, 3][p_partkey % {len(BODIES)} + 1] AS decisions FROM part")
def score_decision_points(spark, d):
    return model.table(spark, d, "part").select("p_partkey", extract.decision_points(_pick("p_partkey", BODIES)[0]).alias("decisions"))


PAGES = ("<form name='f'><c:out/></form>", "<c:forEach items='a'>x</c:forEach>", '<%@ include file="h.jsp" %>', "<p>plain</p>", "<form></form><form></form><% a %><% b %><% c %><% d %><% e %><% f %><% g %><% h %>")


@query(
    "SELECT p_partkey, " + _sql("p_partkey", ("form", "list", "layout", "view", "form")) + " AS kind, [0.9, 0.85, 0.7, 0.7, 0.8][p_partkey % 5 + 1]::double AS confidence, " + _sql("p_partkey", ("simple", "simple", "simple", "simple", "complex")) + " AS complexity FROM part"
)
def score_page_classes(spark, d):
    kind, confidence, level = scoring.page_class(_pick("p_partkey", PAGES)[0])
    return model.table(spark, d, "part").select("p_partkey", kind.alias("kind"), F.round(confidence, 6).cast("double").alias("confidence"), level.alias("complexity"))


HINTED = ("@Service class A", "org.struts.X", "<h:form>", "<c:if>", "@Entity class E", "nothing")


@query("SELECT p_partkey, " + _sql("p_partkey", ("spring", "struts", "jsf", "jstl", "hibernate", "")) + " AS hints FROM part")
def class_framework_hints(spark, d):
    return model.table(spark, d, "part").select("p_partkey", F.array_join(classify.framework_hints(_pick("p_partkey", HINTED)[0]), ",").alias("hints"))


@query(
    "SELECT event_id, json_extract_string(m, '$.a.x') AS x, json_extract_string(m, '$.a.y') AS y, json_extract_string(m, '$.k') AS k, json_extract_string(m, '$.n') AS n, true AS has_both, false AS has_absent "
    "FROM (SELECT event_id, json_merge_patch(json_merge_patch('{\"a\": {\"x\": 1, \"y\": 2}, \"k\": 0}', props), '{\"a\": {\"y\": ' || event_id || '}, \"n\": \"z\"}') AS m FROM events)"
)
def json_merged(spark, d):
    e = model.table(spark, d, "events")
    low = text.deep_merged(F.lit('{"a": {"x": 1, "y": 2}, "k": 0}'), F.col("props"))
    m = text.deep_merged(low, F.concat(F.lit('{"a": {"y": '), "event_id", F.lit('}, "n": "z"}')))
    value = lambda p: F.get_json_object("m", f"$.{p}").alias(p[-1])
    return e.select("event_id", m.alias("m")).select("event_id", value("a.x"), value("a.y"), value("k"), value("n"), text.has_keys(F.col("m"), ["a", "n"]).alias("has_both"), text.has_keys(F.col("m"), ["a", "absent"]).alias("has_absent"))


@query("WITH r AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) SELECT o_custkey, o_orderkey, o_totalprice FROM r WHERE rank <= 3")
def rank_best_of_each(spark, d):
    """A report: the three dearest orders of each customer."""
    o = model.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return aggregate.top_per(o, "o_custkey", 3, [F.desc("o_totalprice"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT p_partkey, CASE WHEN p_name LIKE 'c%' THEN 'cold' WHEN p_name LIKE '%widget' THEN 'widget' ELSE 'rest' END AS first, CASE WHEN p_name LIKE '%widget' THEN 'widget' WHEN p_name LIKE 'c%' THEN 'cold' ELSE 'rest' END AS last FROM part")
def class_by_globs(spark, d):
    rules = [("cold", "c*"), ("widget", "*widget")]
    return model.table(spark, d, "part").select("p_partkey", classify.first_match(F.col("p_name"), rules, "rest").alias("first"), classify.last_match(F.col("p_name"), rules, "rest").alias("last"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'UI' WHEN o_orderkey % 3 = 1 THEN 'Other' ELSE 'none' END AS layer, CASE WHEN o_orderkey % 3 = 0 THEN 'data_access' WHEN o_orderkey % 3 = 1 THEN 'unknown' ELSE 'security' END AS architecture, CASE WHEN o_orderkey % 3 = 0 THEN 'screen' ELSE 'utility' END AS subdomain FROM orders")
def class_layers(spark, d):
    o = model.table(spark, d, "orders")
    layer = classify.to_layer(_pick("o_orderkey", ("ui", "what", "NONE"))[0])
    return o.select("o_orderkey", layer.alias("layer"), classify.to_architecture(_pick("o_orderkey", ("DataAccess", "", "SECURITY"))[0]).alias("architecture"), classify.subdomain_type(layer).alias("subdomain"))
