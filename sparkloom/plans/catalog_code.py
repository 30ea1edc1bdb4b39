"""Queries over code structure. The sources are made from the customers' columns (model.sources); their SQL tells what
each file declares from those columns, without reading the code."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.operators import chunks, layers, structure
from sparkloom.plans import model
from sparkloom.plans.catalog import query

MANAGERS = ["*Manager"]
#: What each source declares: kind, name, type_name, value_type, start_line, end_line, complexity.
_DECLARED = (
    f"WITH {model.SOURCES}, d AS ("
    "SELECT path, 'class' AS kind, c AS name, c AS type_name, NULL AS value_type, 4 AS start_line, 17 + more AS end_line, NULL::int AS complexity FROM src "
    "UNION ALL SELECT path, 'field', 'NOTE', c, 'String', 6, 6, NULL FROM src "
    "UNION ALL SELECT path, 'field', 'manager', c, 'Nation' || n || 'Manager', 7, 7, NULL FROM src "
    "UNION ALL SELECT path, 'field', 'orders', c, 'List<Order' || k % 7 || '>', 8, 8, NULL FROM src "
    "UNION ALL SELECT path, 'constructor', c, c, NULL, 9, 9, 1 FROM src "
    "UNION ALL SELECT path, 'method', 'run', c, 'void', 10, 15, 3 FROM src "
    "UNION ALL SELECT path, 'method', 'm' || i, c, 'int', 16 + i, 16 + i, 1 FROM more "
    "UNION ALL SELECT path, 'class', 'Inner', c || '.Inner', NULL, 16 + more, 16 + more, NULL FROM src "
    "UNION ALL SELECT path, 'field', 'total', c || '.Inner', 'long', 16 + more, 16 + more, NULL FROM src "
    "UNION ALL SELECT path, 'method', 'add', c || '.Inner', 'void', 16 + more, 16 + more, 1 FROM src "
    "UNION ALL SELECT path, 'class', h, h, NULL, 18 + more, 18 + more, NULL FROM src "
    "UNION ALL SELECT path, 'field', 'a', h, 'int', 18 + more, 18 + more, NULL FROM src "
    "UNION ALL SELECT path, 'method', 'createHelper', h, h, 18 + more, 18 + more, 1 FROM src)"
)


@query(f"{_DECLARED} SELECT path, kind, name, type_name, value_type, start_line::int AS start_line, end_line::int AS end_line, complexity FROM d")
def code_declarations(spark, d):
    found = structure.declarations(model.sources(spark, d))
    return found.select("path", "kind", "name", "type_name", "value_type", "start_line", "end_line", "complexity")


@query(
    f"WITH {model.SOURCES} SELECT path, c AS type_name, package, 'public' AS modifiers, 'Service' AS annotations, 'Base' || n AS extends, 'Runnable; Comparable<' || c || '>' AS implements FROM src "
    "UNION ALL SELECT path, c || '.Inner', package, 'static', '', NULL, '' FROM src UNION ALL SELECT path, h, package, '', '', NULL, '' FROM src"
)
def code_types(spark, d):
    found = structure.declarations(model.sources(spark, d)).where("kind = 'class'")
    return found.select("path", "type_name", "package", *(F.array_join(c, "; ").alias(c) for c in ("modifiers", "annotations")), "extends", F.array_join("implements", "; ").alias("implements"))


@query(
    f"WITH {model.SOURCES} SELECT path, c AS type_name, c AS method, 1::bigint AS place, 'Nation' || n || 'Manager' AS type, 'm' AS parameter FROM src "
    "UNION ALL SELECT path, c, 'm' || i, 1, 'String', 'a' FROM more UNION ALL SELECT path, c, 'm' || i, 2, 'List<Integer>', 'b' FROM more UNION ALL SELECT path, c || '.Inner', 'add', 1, 'long', 'v' FROM src"
)
def code_parameters(spark, d):
    found = structure.declarations(model.sources(spark, d)).where("kind IN ('method', 'constructor')")
    return found.select("path", "type_name", F.col("name").alias("method"), F.posexplode("parameters").alias("at", "p")).select("path", "type_name", "method", (F.col("at") + 1).cast("bigint").alias("place"), F.col("p.type").alias("type"), F.col("p.name").alias("parameter"))


@query(
    f"WITH {model.SOURCES} SELECT path, c AS type_name, 'manager' AS receiver, 'load' AS name, 'Nation' || n || 'Manager' AS target_type, 'field' AS via FROM src "
    "UNION ALL SELECT path, c, part, 'getInstance', part, 'static' FROM src WHERE odd UNION ALL SELECT path, c, 'p', 'find', part, 'local' FROM src WHERE odd "
    "UNION ALL SELECT path, c, 'manager', 'go', 'Order' || i, 'local' FROM more UNION ALL SELECT path, c, 'helper', 'size', NULL, 'unknown' FROM more"
)
def code_resolved_calls(spark, d):
    return structure.resolved_calls(model.sources(spark, d)).select("path", "type_name", "receiver", "name", "target_type", "via")


@query(f"WITH {model.SOURCES} SELECT path, c AS type_name, 1::bigint AS manager_fields, CASE WHEN odd THEN 3 ELSE 1 END::bigint AS manager_calls, CASE WHEN odd THEN 2 ELSE 1 END::bigint AS unique_managers, CASE WHEN odd THEN 4 ELSE 2 END::bigint AS score, odd AS is_orchestrator FROM src")
def code_orchestration(spark, d):
    return structure.orchestration(model.sources(spark, d), MANAGERS)


@query(f"WITH {model.SOURCES} SELECT path, h AS type_name, 'createHelper' AS name, h AS value_type, (18 + more)::int AS start_line, 'create*' AS matched_pattern FROM src")
def code_factory_methods(spark, d):
    return structure.factory_methods(model.sources(spark, d), ["make*", "create*", "static create*"])


@query(f"WITH {model.SOURCES}, i AS (SELECT path, c AS type_name, unnest(['Runnable', 'Comparable<' || c || '>']) AS interface, 4 AS start_line FROM src) SELECT * FROM i")
def code_interfaces(spark, d):
    return structure.type_interfaces(model.sources(spark, d))


_CLASS_TEXT = (
    "'class ' || c || ' package ' || package || ' annotation Service extends Base' || n || ' implements Runnable implements Comparable<' || c || '> method public void run' "
    "|| CASE WHEN more > 0 THEN ' method public int m0' ELSE '' END || CASE WHEN more > 1 THEN ' method public int m1' ELSE '' END "
    "|| ' field private String NOTE field private Nation' || n || 'Manager manager field protected List<Order' || k % 7 || '> orders'"
)


@query(
    f"WITH {model.SOURCES} SELECT path, 'class' AS chunk_type, 4 AS start_line, {_CLASS_TEXT} AS content, (1 + more)::varchar AS methods, NULL AS complexity, c AS class_name, 'java' AS language FROM src "
    "UNION ALL SELECT path, 'class', (16 + more)::int, 'class Inner package ' || package || ' method package void add field package long total', '1', NULL, c || '.Inner', 'java' FROM src "
    "UNION ALL SELECT path, 'class', (18 + more)::int, 'class ' || h || ' package ' || package || ' method public ' || h || ' createHelper field package int a', '1', NULL, h, 'java' FROM src "
    "UNION ALL SELECT path, 'method', 10, 'method run in class ' || c || ' visibility public returns void annotation Override modifier public', NULL, '3', c, 'java' FROM src "
    "UNION ALL SELECT path, 'method', (16 + i)::int, 'method m' || i || ' in class ' || c || ' visibility public returns int parameter String a parameter List<Integer> b modifier public', NULL, '1', c, 'java' FROM more "
    "UNION ALL SELECT path, 'method', (16 + more)::int, 'method add in class Inner visibility package returns void parameter long v', NULL, '1', c || '.Inner', 'java' FROM src "
    "UNION ALL SELECT path, 'method', (18 + more)::int, 'method createHelper in class ' || h || ' visibility public returns ' || h || ' modifier public modifier static', NULL, '1', h, 'java' FROM src"
)
def code_chunks(spark, d):
    files = model.sources(spark, d).select("path", F.lit("java").alias("language"), F.lit("source").alias("type"), "text")
    m = lambda k: F.try_element_at("metadata", F.lit(k))
    found = chunks.chunks(files, ["path", "language", "type"])
    return found.select(F.col("source_path").alias("path"), "chunk_type", "start_line", "content", m("methods_count").alias("methods"), m("complexity_score").alias("complexity"), m("class_name").alias("class_name"), m("file_language").alias("language"))


@query(
    "WITH t AS (SELECT page_id, html, list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(html, '<([0-9A-Za-z_]+(?::[0-9A-Za-z_]+)?)[\\s/>]', 1), lambda x: lower(x)), lambda x: x NOT IN ('" + "', '".join(chunks.FIELDS) + "')))) AS e FROM pages) "
    "SELECT page_id, 'jsp page' || CASE WHEN len(e) > 0 THEN ' ' || array_to_string(list_transform(e, lambda x: 'element ' || x), ' ') ELSE '' END AS content, len(e)::varchar AS elements, '0' AS forms FROM t WHERE NOT regexp_matches(html, '(?i)<form')"
)
def page_chunk_texts(spark, d):
    pages = model.table(spark, d, "pages").where("NOT html RLIKE '(?i)<form'").select("page_id", F.concat(F.lit("p"), "page_id").alias("path"), F.col("html").alias("text"))
    found = chunks.page_chunks(pages).join(pages.select("page_id", F.col("path").alias("source_path")), "source_path")
    return found.select("page_id", "content", F.col("own")["elements_count"].alias("elements"), F.col("own")["forms_count"].alias("forms"))


#: Rules of the layers, in order, for packages and for code.
PACKAGE_RULES = (("UI", "com.**.controller.**"), ("Service", "com.**.service.**"), ("Database", "com.**.dao.**"), ("Database", "com.**.repository.**"), ("Integration", "com.**.client.**"), ("Reporting", "com.**.report.**"), ("Reporting", "com.**.reports.**"), ("Reporting", "com.**.dashboard.**"), ("Configuration", "com.**.config.**"))
CODE_SIGNS = (("UI", "@Controller"), ("UI", "@RestController"), ("UI", "Servlet"), ("UI", "Handler"), ("Service", "@Service"), ("Service", "@Component"), ("Service", "Processor"), ("Database", "@Repository"), ("Database", "@Entity"), ("Reporting", "*Report*"))


def _rules(spark, rules, name):
    return spark.createDataFrame([(k, layer, x) for k, (layer, x) in enumerate(rules)], f"ord int, layer string, {name} string")


@query(
    f"WITH {model.SOURCES}, p AS (SELECT path, package, CASE "
    + " ".join("WHEN regexp_matches(package, '{}') THEN '{}'".format(g.replace("**", ".*"), layer) for layer, g in PACKAGE_RULES)
    + " END AS p FROM src) SELECT path, package, coalesce(p, 'Service') AS layer, CASE WHEN p IS NULL THEN 'code' ELSE 'package' END AS by FROM p"
)
def code_layers(spark, d):
    files = model.sources(spark, d)
    return layers.detected(files, structure.declarations(files), _rules(spark, PACKAGE_RULES, "pattern"), _rules(spark, CODE_SIGNS, "sign"), {"@Path": "UI"})


#: Patterns over directories of the files, as many as a project has.
PATH_RULES = tuple((layer, f"**/{word}*/**") for layer, word in (("Application", "src1"), ("Business", "src2"), ("DataAccess", "src3"), ("Security", "en"), ("Shared", "src")))


@query(f"WITH {model.FILES} SELECT '/' || path AS value, CASE " + " ".join("WHEN regexp_matches('/' || path, '(?i){}') THEN '{}'".format(g.replace("**", "\x00").replace("*", "[^/]*").replace("\x00", ".*"), layer) for layer, g in PATH_RULES) + " ELSE 'Other' END AS layer FROM files")
def path_layers(spark, d):
    f = model.files(spark, d).select(F.concat(F.lit("/"), "path").alias("p"))
    return layers.matched(f, "p", _rules(spark, PATH_RULES, "pattern"), "/").select("value", "layer")


PREFIXES = ("com.p1", "com.p2.core", "com.p33.", "com.p1.core", "org")


@query(
    "WITH e AS (SELECT l_orderkey, l_linenumber, 'com.p' || l_suppkey % 50 || '.core' AS package, 'com.p' || l_partkey % 50 || '.core' AS target, 'com.p' || l_partkey % 50 || '.core.Part' || l_partkey || '.load' AS to_reference FROM lineitem), "
    "p(prefix) AS (VALUES " + ", ".join(f"('{x}')" for x in PREFIXES) + ") "
    "SELECT l_orderkey, l_linenumber, to_reference, (SELECT prefix FROM p WHERE starts_with(target, prefix) ORDER BY length(prefix) DESC LIMIT 1) AS prefix FROM e WHERE target <> package AND EXISTS (SELECT 1 FROM p WHERE starts_with(target, prefix))"
)
def code_edges_to_packages(spark, d):
    li = model.table(spark, d, "lineitem")
    e = li.select("l_orderkey", "l_linenumber", F.concat(F.lit("com.p"), F.col("l_suppkey") % 50, F.lit(".core")).alias("package"), F.concat(F.lit("com.p"), F.col("l_partkey") % 50, F.lit(".core.Part"), "l_partkey", F.lit(".load")).alias("to_reference"))
    listed = spark.createDataFrame([(x,) for x in PREFIXES], "prefix string")
    return layers.filtered(e, listed, exclude_same=True).select("l_orderkey", "l_linenumber", "to_reference", "prefix")


@query(
    f"WITH {model.SOURCES}, e AS (SELECT path, package || '.' || c AS f, 'Nation' || n || 'Manager.load' AS t, unnest(['method_call', 'service_dependency']) AS k FROM src "
    "UNION ALL SELECT path, package || '.' || c, part || '.' || unnest(['getInstance', 'find']), 'method_call' FROM src WHERE odd "
    "UNION ALL SELECT path, package || '.' || c, part || '.' || unnest(['getInstance', 'find']), 'service_dependency' FROM src WHERE odd "
    "UNION ALL SELECT path, package || '.' || c, 'Order' || i || '.go', 'method_call' FROM more "
    "UNION ALL SELECT path, package || '.' || c, unnest(['Runnable', 'Comparable<' || c || '>']), 'interface_implementation' FROM src "
    "UNION ALL SELECT path, package || '.' || c, 'ORCHESTRATION_PATTERN', 'orchestration' FROM src WHERE odd "
    "UNION ALL SELECT path, package || '.' || h || '.createHelper', h, 'factory_method' FROM src) SELECT path, f AS from_reference, t AS to_reference, k AS mapping_type FROM e"
)
def code_structure_edges(spark, d):
    return structure.edges(model.sources(spark, d), ["*Manager", "create*"]).select("path", "from_reference", "to_reference", "mapping_type")
