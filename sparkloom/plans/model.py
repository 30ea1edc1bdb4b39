"""The model's tables, as views of the provided ones; each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hints of a document: name and pattern (safe for any regex engine).
HINTS = (("digits", "[0-9]{4}"), ("license", "[Ll]icen[sc]ed? under"), ("mail", "@[a-z0-9]+[.]"), ("shout", "[A-Z]{4}!!"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of few bytes that much work is made of, over as many tasks as a shuffle has: a file of a million keys is one
    split. Dealt by a key, what is grouped by it later needs no other shuffle."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id",
        F.concat_ws("/", "source", "lang", F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".txt"))).alias("path"),
        F.col("lang").alias("language"),
        F.col("source").alias("source_location"),
        F.col("n_chars").alias("size_bytes"),
        F.concat(F.lit("doc_"), "doc_id").alias("functional_name"),
        F.expr("CASE WHEN n_chars < 500 THEN 'UI' WHEN n_chars < 2000 THEN 'Service' WHEN n_chars < 5000 THEN 'Database' WHEN n_chars < 9000 THEN 'Integration' END").alias("layer"),
        F.array_compact(F.array(*(F.when(F.col("text").rlike(p), F.lit(n)) for n, p in HINTS))).alias("framework_hints"),
        "text",
    )


FILES = (
    "files AS (SELECT doc_id, source || '/' || lang || '/doc_' || doc_id || '.txt' AS path, lang AS language, source AS source_location, n_chars AS size_bytes, "
    "'doc_' || doc_id AS functional_name, CASE WHEN n_chars < 500 THEN 'UI' WHEN n_chars < 2000 THEN 'Service' WHEN n_chars < 5000 THEN 'Database' WHEN n_chars < 9000 THEN 'Integration' END AS layer, "
    "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{n}' END" for n, p in HINTS) + "], lambda x: x IS NOT NULL) AS framework_hints, text FROM documents)"
)


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> part by return flag, confidence 1 - discount."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    own = li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_discount", "l_quantity")
    joined = own.join(o.select("o_orderkey", "o_custkey"), own.l_orderkey == o.o_orderkey)
    return joined.select(
        F.concat_ws("_", F.lit("line"), "l_orderkey", "l_linenumber").alias("id"),
        F.concat(F.lit("customer_"), "o_custkey").alias("from_id"),
        F.concat(F.lit("part_"), "l_partkey").alias("to_id"),
        F.expr("CASE l_returnflag WHEN 'A' THEN 'readsFrom' WHEN 'N' THEN 'writesTo' ELSE 'deletesFrom' END").alias("type"),
        F.round(1 - F.col("l_discount"), 4).alias("confidence"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_suppkey").alias("supp_key"),
    )


RELATIONS = (
    "relations AS (SELECT 'line_' || l_orderkey || '_' || l_linenumber AS id, 'customer_' || o_custkey AS from_id, 'part_' || l_partkey AS to_id, "
    "CASE l_returnflag WHEN 'A' THEN 'readsFrom' WHEN 'N' THEN 'writesTo' ELSE 'deletesFrom' END AS type, round(1 - l_discount, 4) AS confidence, l_orderkey AS order_key, l_suppkey AS supp_key "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
)


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as routes: id, host, path (without query or fragment)."""
    p = table(spark, sf_dir, "pages")
    rest = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[?#].*$", "")
    return p.select("page_id", F.concat(F.lit("page_"), "page_id").alias("id"), F.regexp_extract(rest, "^([^/]*)", 1).alias("host"), F.regexp_replace(rest, "^[^/]*", "").alias("path"), "html")


ROUTES = "routes AS (SELECT page_id, 'page_' || page_id AS id, regexp_extract(rest, '^([^/]*)', 1) AS host, regexp_replace(rest, '^[^/]*', '') AS path, html FROM (SELECT page_id, html, regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', '') AS rest FROM pages))"


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page to link targets, one row a link with its place."""
    from sparkloom.functions.extract import links

    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(links(F.col("html"))).alias("at", "href"))


LINKS = "links AS (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*href=[\"'']([^\"'']*)[\"'']', 1)) AS href FROM pages)"


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source file a customer: path, text. What it declares follows from the customer's columns, as SQL can tell:
    strings and comments with braces, two types in one file, a nested one, 0 to 2 further methods (by key), and
    a manager of its own or, for odd keys, one more. Few bytes and much work, so the rows are dealt out."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    #: Dealt by path before the texts are made: they are not shuffled, and neither is what is grouped by path.
    c = dealt(c.withColumn("path", F.concat(F.lit("src/n"), "c_nationkey", F.lit("/C"), "c_custkey", F.lit(".java"))), "path")
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    layer = F.element_at(F.array(*map(F.lit, LAYER_PACKAGES)), (F.pmod("c_custkey", F.lit(len(LAYER_PACKAGES))) + 1).cast("int"))
    odd = F.col("c_custkey") % 2 == 1
    more = F.transform(F.sequence(F.lit(0), (F.col("c_custkey") % 3).cast("int")), lambda i: F.when(i > 0, F.concat(F.lit("    public int m"), i - 1, F.lit("(String a, List<Integer> b) { Order"), i - 1, F.lit(" manager = null; manager.go(); return helper.size(); }\n"))).otherwise(""))
    part = F.concat(F.lit("Part"), F.col("c_custkey") % 5, F.lit("Manager"))
    lines = F.concat(
        F.lit("package com.acme."), F.lower("c_mktsegment"), F.lit("."), layer, F.lit(";\nimport java.util.List;\n/* class Ghost { */\n@Service(\"c"), key, F.lit("\")\npublic class C"), key,
        F.lit(" extends Base"), nation, F.lit(" implements Runnable, Comparable<C"), key, F.lit("> {\n    private static final String NOTE = \"} class Fake {\"; // }\n    private Nation"), nation,
        F.lit("Manager manager;\n    protected List<Order"), F.col("c_custkey") % 7, F.lit("> orders;\n    public C"), key, F.lit("(Nation"), nation, F.lit("Manager m) { this.manager = m; }\n"),
        F.lit("    @Override\n    public void run() {\n        if (orders != null) { for (int i = 0; i < 3; i++) { manager.load(i); } }\n"),
        F.when(odd, F.concat(F.lit("        "), part, F.lit(" p = "), part, F.lit(".getInstance();\n        p.find(\"x\");\n"))).otherwise(F.lit("        // p = null;\n        /* p.find(); { */\n")),
        F.lit("    }\n"), F.array_join(more, ""),
        F.lit("    static class Inner { long total; void add(long v) { total = total + v; } }\n}\nclass Helper"), key, F.lit(" { int a = 1; public static Helper"), key, F.lit(" createHelper() { return new Helper"), key, F.lit("(); } }\n"),
    )
    return c.select("c_custkey", "path", lines.alias("text"))


#: Last package segment of the sources, by key.
LAYER_PACKAGES = ("controller.web", "service.core", "dao", "client.http", "reports.pdf", "config.app", "misc")
SOURCES = (
    "src AS (SELECT c_custkey AS k, 'src/n' || c_nationkey || '/C' || c_custkey || '.java' AS path, 'C' || c_custkey AS c, 'Helper' || c_custkey AS h, c_nationkey AS n, c_custkey % 3 AS more, c_custkey % 2 = 1 AS odd, 'Part' || c_custkey % 5 || 'Manager' AS part, "
    "'com.acme.' || lower(c_mktsegment) || '.' || ['" + "', '".join(LAYER_PACKAGES) + f"'][c_custkey % {len(LAYER_PACKAGES)} + 1] AS package FROM customer), "
    "more AS (SELECT src.*, unnest(range(0, more)) AS i FROM src)"
)


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.concat(F.lit("chunk_"), "vec_id").alias("chunk_id"), F.col("label").cast("string").alias("chunk_type"), F.col("embedding").cast("array<double>").alias("embedding"))


CHUNKS = "chunks AS (SELECT vec_id, 'chunk_' || vec_id AS chunk_id, label::varchar AS chunk_type, embedding::double[] AS embedding FROM embeddings)"
#: The scalar product, summed in order as the other engine's fold does.
DOT = "list_reduce(list_prepend(0.0::double, list_transform(range(1, len({a}) + 1), lambda i: {a}[i] * {b}[i])), lambda s, x: s + x)"
