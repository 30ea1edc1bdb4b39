"""The query catalogue: names, builders over the whole tables, and the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import checks, classify, ddl, extract, paths, scoring, text
from sparkloom.operators import aggregate, assemble, code, configs, gates, graph, inventory, linking, pages, reports, security, vectors
from sparkloom.plans import model, render
from sparkloom.streaming import progress

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(build):
        QUERIES[build.__name__] = build
        if sql:
            SQL[build.__name__] = sql
        return build

    return add


# Inventory: filters, counts, groups


@query(f"WITH {model.FILES} SELECT source_location, count(*) AS n FROM files WHERE language = 'en' AND size_bytes >= 1000 GROUP BY 1")
def inv_minimum_slice(spark, d):
    return inventory.files(model.files(spark, d)).language("en").min_size(1000).count_by("source_location")


@query(f"WITH {model.FILES} SELECT language, count(*) AS n FROM files GROUP BY 1")
def inv_count_by_language(spark, d):
    return inventory.files(model.files(spark, d)).count_by("language")


@query(f"WITH {model.FILES} SELECT count(*) AS n FROM files WHERE language IN ('fr', 'de') AND size_bytes BETWEEN 500 AND 5000")
def inv_filter_size_lang(spark, d):
    return inventory.files(model.files(spark, d)).language("fr").language("de").min_size(500).max_size(5000).count()


@query(f"WITH {model.FILES} SELECT doc_id, path FROM files WHERE contains(path, '/en/') AND regexp_matches(path, 'doc_[0-9]*7[.]txt$') AND starts_with(path, 'src1') AND ends_with(path, '.txt')")
def inv_path_predicates(spark, d):
    return inventory.files(model.files(spark, d)).path_contains("/en/").path_regex(r"doc_[0-9]*7[.]txt$").path_startswith("src1").path_endswith(".txt").execute().select("doc_id", "path")


@query(f"WITH {model.FILES} SELECT language, count(*) AS n FROM files WHERE len(list_intersect(framework_hints, ['license', 'mail'])) > 0 GROUP BY 1")
def inv_hint_overlap(spark, d):
    return inventory.files(model.files(spark, d)).framework_hint("license", "mail").has_framework_hints().count_by("language")


@query(f"WITH {model.FILES} SELECT count(*) AS n FROM files WHERE len(framework_hints) = 0")
def inv_without_hints(spark, d):
    return inventory.files(model.files(spark, d)).has_framework_hints(False).count()


@query(f"WITH {model.FILES} SELECT coalesce(layer, 'none') AS layer, count(*) AS n FROM files WHERE layer = 'Service' OR layer IS NULL GROUP BY 1")
def inv_layer_filter(spark, d):
    q = inventory.files(model.files(spark, d)).layer("Service", "Other").execute()
    return q.groupBy(F.coalesce("layer", F.lit("none")).alias("layer")).agg(F.count("*").alias("n"))


@query(f"WITH {model.FILES} SELECT source_location, count(*) AS n, string_agg(functional_name, ',' ORDER BY functional_name) AS members FROM files WHERE size_bytes >= 9000 GROUP BY 1")
def inv_group_collect(spark, d):
    return inventory.files(model.files(spark, d)).min_size(9000).group_by("source_location", "functional_name")


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)")
def inv_exists_nested(spark, d):
    nested = model.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.struct("l_quantity")).alias("items"))
    return inventory.files(model.table(spark, d, "orders").join(nested, "o_orderkey")).has_nested("items", lambda x: x["l_quantity"] > 45).execute().select("o_orderkey")


@query(f"WITH {model.FILES} SELECT path, size_bytes FROM files WHERE language = 'de' ORDER BY size_bytes DESC, path LIMIT 1")
def inv_first(spark, d):
    return inventory.files(model.files(spark, d)).language("de").execute().orderBy(F.desc("size_bytes"), "path").limit(1).select("path", "size_bytes")


@query(f"WITH {model.FILES} SELECT doc_id, size_bytes FROM files WHERE size_bytes >= 8000")
def inv_large_files(spark, d):
    return inventory.large_files(model.files(spark, d), 8000).select("doc_id", "size_bytes")


@query(f"WITH {model.FILES} SELECT doc_id FROM files WHERE regexp_matches(path, '^src2/.*/doc_.[.]txt$')")
def inv_glob(spark, d):
    return inventory.by_glob(model.files(spark, d), "src2/*/doc_?.txt").select("doc_id")


@query(f"WITH {model.FILES} SELECT language, count(*) AS n FROM files WHERE language IN ('en', 'es') AND regexp_matches(path, '^src1.*$') AND NOT regexp_matches(path, '^src11/.*$') GROUP BY 1")
def inv_scope(spark, d):
    return inventory.in_scope(model.files(spark, d), ["en", "es"], ["src1*"], ["src11/*"]).groupBy("language").agg(F.count("*").alias("n"))


@query(f"WITH {model.FILES} SELECT doc_id FROM files WHERE contains(functional_name, '99')")
def inv_functional_name(spark, d):
    return inventory.files(model.files(spark, d)).functional_name_contains("99").execute().select("doc_id")


# Statistics, rankings, roll-ups


@query(f"WITH {model.FILES}, v(key) AS (VALUES ('UI'), ('Service'), ('Database'), ('Integration'), ('Utility'), ('Other')) SELECT v.key, count(f.doc_id) AS n FROM v LEFT JOIN files f ON v.key = coalesce(f.layer, 'Other') GROUP BY 1")
def inv_stats_domain_histogram(spark, d):
    return aggregate.domain_histogram(model.files(spark, d), F.col("layer"), ["UI", "Service", "Database", "Integration", "Utility"], "Other")


@query(f"WITH {model.FILES} SELECT CASE WHEN size_bytes > 10240 THEN 'large' WHEN size_bytes > 1024 THEN 'medium' ELSE 'small' END AS bucket, count(*) AS n, sum(size_bytes)::bigint AS bytes FROM files GROUP BY 1")
def inv_size_buckets(spark, d):
    bucket = F.when(F.col("size_bytes") > 10240, "large").when(F.col("size_bytes") > 1024, "medium").otherwise("small")
    return model.files(spark, d).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), F.sum("size_bytes").alias("bytes"))


@query(f"WITH {model.FILES} SELECT source_location, size_bytes, count(*) AS n FROM files GROUP BY 1, 2 HAVING count(*) > 1")
def inv_duplicates_having(spark, d):
    return aggregate.duplicates(model.files(spark, d), "source_location", "size_bytes")


@query(f"WITH {model.FILES} SELECT source_location, count(*) AS n FROM files GROUP BY 1 ORDER BY n DESC, source_location LIMIT 10")
def inv_top10(spark, d):
    return aggregate.top(inventory.files(model.files(spark, d)).count_by("source_location"), 10, [F.desc("n"), F.col("source_location")])


@query(f"WITH {model.FILES} SELECT count(*) AS n_files, sum(size_bytes)::bigint AS total_size, count(DISTINCT language) AS n_languages, count(DISTINCT source_location) AS n_locations, count(*) FILTER (len(framework_hints) > 0) AS n_hinted, count(*) FILTER (layer = 'Other') AS n_other, round(sum(CASE WHEN size_bytes > 0 THEN size_bytes END)::double / count(*), 2) AS average_size FROM files")
def inv_statistics(spark, d):
    return aggregate.statistics(model.files(spark, d))


@query(f"WITH {model.FILES}, g AS (SELECT source_location, language, count(*) AS n_files, count(DISTINCT layer) AS n_layers, sum(len(framework_hints))::bigint AS n_hints FROM files GROUP BY 1, 2) SELECT source_location, language, round(least(0.9, 0.6 + CASE WHEN n_files > 3 THEN 0.2 ELSE 0 END + CASE WHEN n_layers > 1 THEN 0.1 ELSE 0 END + CASE WHEN n_hints > 0 THEN 0.1 ELSE 0 END)::double, 6) AS confidence FROM g")
def inv_subdomain_confidence(spark, d):
    g = model.files(spark, d).groupBy("source_location", "language").agg(F.count("*").alias("n_files"), F.countDistinct("layer").alias("n_layers"), F.sum(F.size("framework_hints")).alias("n_hints"))
    return g.select("source_location", "language", F.round(scoring.subdomain_confidence(F.col("n_files"), F.col("n_layers"), F.col("n_hints")), 6).alias("confidence"))


@query(f"WITH {model.FILES} SELECT language, count(*) AS n, round(count(*)::double / (SELECT count(*) FROM files), 6) AS share FROM files GROUP BY 1")
def inv_shares(spark, d):
    return aggregate.shares(model.files(spark, d), "language")


@query(f"WITH {model.FILES}, g AS (SELECT source_location, language, count(*) AS n FROM files GROUP BY 1, 2) SELECT source_location, arg_min(language, (-n, language)) AS primary_language FROM g GROUP BY 1")
def inv_primary_language(spark, d):
    g = inventory.files(model.files(spark, d)).count_by("source_location", "language")
    return g.groupBy("source_location").agg(aggregate.argmax("language", F.col("n")).alias("primary_language"))


@query(f"WITH {model.FILES} SELECT source_location, count(*) FILTER (language = 'en') AS n_en, count(*) FILTER (language = 'fr') AS n_fr, count(*) FILTER (language = 'de') AS n_de FROM files GROUP BY 1")
def inv_pivot(spark, d):
    return aggregate.pivot_counts(model.files(spark, d), "source_location", "language", ["en", "fr", "de"])


@query(f"WITH {model.FILES}, r AS (SELECT language, doc_id, size_bytes, row_number() OVER (PARTITION BY language ORDER BY size_bytes DESC, doc_id) AS rank FROM files) SELECT * FROM r WHERE rank <= 3")
def inv_top_per_language(spark, d):
    return aggregate.top_per(model.files(spark, d).select("language", "doc_id", "size_bytes"), "language", 3, [F.desc("size_bytes"), F.col("doc_id")])


@query(f"WITH {model.ROUTES}, s AS (SELECT list_filter(string_split(path, '/'), lambda x: x <> '') AS p FROM routes), e AS (SELECT array_to_string(p[1:i], '/') AS prefix, i FROM (SELECT p, unnest(range(1, len(p) + 1)) AS i FROM s)) SELECT prefix, max(i)::int AS level, count(*) AS n FROM e GROUP BY 1 HAVING count(*) >= 2")
def path_prefix_rollup(spark, d):
    return aggregate.prefix_rollup(model.routes(spark, d), F.col("path"))


# Paths, names, hashes


@query(f"WITH {model.ROUTES}, p AS (SELECT page_id, CASE WHEN path IN ('', '/') THEN path ELSE regexp_replace(path, '/$', '') END AS p FROM routes) SELECT page_id, p AS normal, CASE WHEN contains(p, '/') THEN regexp_replace(p, '/[^/]*$', '') ELSE '.' END AS parent, regexp_extract(p, '([^/]*)$', 1) AS name, regexp_replace(regexp_extract(p, '([^/]*)$', 1), '(.)[.][^.]*$', '\\1') AS stem, lower(regexp_extract(regexp_extract(p, '([^/]*)$', 1), '.([.][^.]*)$', 1)) AS ext FROM p")
def path_algebra(spark, d):
    p = F.col("path")
    return model.routes(spark, d).select("page_id", paths.normalize_path(p).alias("normal"), paths.parent_path(p).alias("parent"), paths.filename(p).alias("name"), paths.stem(p).alias("stem"), paths.extension(p).alias("ext"))


@query(f"WITH {model.ROUTES} SELECT page_id, regexp_replace(path, '[^A-Za-z0-9_:.-]+', '_', 'g') AS slug, regexp_replace(path, '^[/*]+', '') AS action, 'route_' || regexp_replace(path, '[^A-Za-z0-9]+', '_', 'g') || '_GET' AS rest_id, 'route_' || replace(replace(host || '_' || regexp_replace(path, '^[/*]+', ''), '/', '_'), '*', 'STAR') AS route FROM routes")
def slug_and_route_ids(spark, d):
    p = F.col("path")
    return model.routes(spark, d).select("page_id", paths.slug(p).alias("slug"), paths.normalize_action(p).alias("action"), paths.rest_route_id(p, F.lit("get")).alias("rest_id"), paths.route_id(F.col("host"), paths.normalize_action(p)).alias("route"))


_SEG = "list_filter(string_split(lower(a), '/'), lambda x: x <> '')"
_BY = lambda i: "CASE " + " ".join(f"WHEN contains(s[{i}], '{w}') THEN '{n}'" for w, n in paths.DOMAIN_WORDS) + " END"


@query(f"WITH s AS (SELECT p_partkey, {_SEG} AS s FROM (SELECT p_partkey, '/' || replace(p_type, ' ', '/') || '/' || replace(p_name, ' ', '/') AS a FROM part)) SELECT p_partkey, coalesce({_BY(1)}, {_BY(2)}, CASE WHEN length(s[1]) > 2 THEN s[1] END, 'general') AS domain FROM s")
def domain_from_path(spark, d):
    path = F.concat(F.lit("/"), F.replace("p_type", F.lit(" "), F.lit("/")), F.lit("/"), F.replace("p_name", F.lit(" "), F.lit("/")))
    return model.table(spark, d, "part").select("p_partkey", paths.business_domain(path).alias("domain"))


@query("WITH a AS (SELECT p_partkey, regexp_replace(regexp_replace(trim(p_name), '[_./\\\\-]', ' ', 'g'), '([a-z0-9])([A-Z])', '\\1 \\2', 'g') AS s FROM part), b AS (SELECT p_partkey, trim(regexp_replace(regexp_replace(s, ' +(?:" + text.TECHNICAL + ")$', ''), ' +', ' ', 'g')) AS s FROM a) SELECT p_partkey, upper(substr(s, 1, 1)) || substr(s, 2) AS name FROM b")
def humanize_names(spark, d):
    return model.table(spark, d, "part").select("p_partkey", text.humanize(F.col("p_name")).alias("name"))


@query("SELECT doc_id, ('0x' || substr(md5(doc_id::varchar), 1, 8))::bigint % 10000000 / 1e7 AS fraction FROM documents WHERE ('0x' || substr(md5(doc_id::varchar), 1, 8))::bigint % 10000000 / 1e7 < 0.25")
def hash_sampling(spark, d):
    f = text.hash_fraction(F.col("doc_id"))
    return model.table(spark, d, "documents").select("doc_id", f.alias("fraction")).where("fraction < 0.25")


@query("SELECT sha1(text) AS key, min(doc_id) AS first_id, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def content_hash_groups(spark, d):
    t = model.table(spark, d, "documents").select(vectors.text_hash(F.col("text")).alias("key"), "doc_id")
    return t.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")


@query("SELECT event_id, coalesce(json_extract_string(props, '$.k'), 'none') AS k, coalesce(json_extract_string(props, '$.absent'), 'none') AS absent FROM events")
def nested_json_default(spark, d):
    return model.table(spark, d, "events").select("event_id", text.nested_value(F.col("props"), "k", "none").alias("k"), text.nested_value(F.col("props"), "absent", "none").alias("absent"))


@query()
def first_json_object(spark, d):
    c = model.table(spark, d, "conversations")
    return c.select("conv_id", "turn", text.first_json(F.concat_ws(" ", "text", F.to_json(F.struct("role", "turn")))).alias("found"))


@query("SELECT conv_id, turn, md5(conv_id || ':' || role)[1:12] AS id, CASE role WHEN 'system' THEN 'SYSTEM' ELSE role END AS shown FROM conversations")
def component_ids(spark, d):
    c = model.table(spark, d, "conversations")
    return c.select("conv_id", "turn", F.substring(F.md5(F.concat_ws(":", "conv_id", "role")), 1, 12).alias("id"), F.when(F.col("role") == "system", "SYSTEM").otherwise(F.col("role")).alias("shown"))


# Scores and classes


def _weighted(column: str, rules) -> str:
    return " + ".join(f"len(regexp_extract_all({column}, '(?is){p}')) * {w}" for p, w in rules)


_LANGS = dict(sorted(scoring.LANGUAGES.items()))
_TOP = f"greatest({', '.join(_LANGS)})"


@query("WITH s AS (SELECT page_id, " + ", ".join(f"({_weighted('html', r)})::bigint AS {k}" for k, r in _LANGS.items()) + f" FROM pages) SELECT page_id, {', '.join(_LANGS)}, CASE WHEN {_TOP} < 1 THEN NULL " + " ".join(f"WHEN {k} = {_TOP} THEN '{k}'" for k in _LANGS) + " END AS best FROM s")
def web_scores(spark, d):
    s = {k: v.cast("bigint") for k, v in scoring.scores(F.col("html"), _LANGS).items()}
    rows = model.table(spark, d, "pages").select("page_id", *(v.alias(k) for k, v in s.items()))
    return rows.select("page_id", *_LANGS, scoring.best({k: F.col(k) for k in _LANGS}).alias("best"))


_SQLRULES = scoring.LANGUAGES["sql"]


@query(f"SELECT doc_id, ({_weighted('text', _SQLRULES)})::bigint AS score FROM documents")
def language_score(spark, d):
    return model.table(spark, d, "documents").select("doc_id", scoring.weighted(F.col("text"), _SQLRULES).cast("bigint").alias("score"))


#: Statements, one a part; {n} is its size.
STATEMENTS = (
    "SELECT a, b FROM t{n} JOIN u ON t{n}.id = u.id WHERE a IN (SELECT a FROM v)",
    "insert into sales.orders{n} (a) values (1)",
    "UPDATE staff{n} SET a = 1",
    "DELETE FROM old_rows{n}",
    "CREATE TABLE hr.people{n} (id INT IDENTITY(1,1), at DATETIME DEFAULT GETDATE())",
    "CREATE VIEW v{n} AS SELECT DISTINCT x FROM yy{n}",
    "CREATE INDEX i{n} ON t (a)",
    "CREATE PROCEDURE p{n} AS SELECT 1",
    "CREATE TRIGGER g{n} ON t",
    "ALTER TABLE t{n} ADD c INT",
    "DROP TABLE #tmp{n}",
    "GRANT SELECT ON t TO r",
    "-- note",
    "WITH c AS (SELECT 1) SELECT CASE WHEN a THEN 1 END, row_number() OVER (ORDER BY a) FROM c{n} UNION SELECT 2, 3",
    "COMMIT",
    "EXEC run_all",
)


def statements(spark, d):
    template = F.element_at(F.array(*map(F.lit, STATEMENTS)), (F.col("p_partkey") % len(STATEMENTS) + 1).cast("int"))
    return model.table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.replace(template, F.lit("{n}"), F.col("p_size").cast("string")).alias("sql"))


_STATEMENTS = "st AS (SELECT p_partkey AS id, replace([" + ", ".join("'{}'".format(s.replace("'", "''")) for s in STATEMENTS) + "][p_partkey % " + str(len(STATEMENTS)) + " + 1], '{n}', p_size::varchar) AS sql FROM part)"


@query(f"WITH {_STATEMENTS} SELECT id, CASE " + " ".join(f"WHEN starts_with(upper(trim(sql)), '{a}') THEN '{b}'" for a, b in text.STATEMENTS) + " ELSE 'OTHER' END AS class FROM st")
def sql_classify(spark, d):
    return statements(spark, d).select("id", text.statement_class(F.col("sql")).alias("class"))


_AFTER = " || ".join(f"regexp_extract_all(sql, '(?i)\\b{k.replace(' ', chr(92) + 's+')}\\s+([a-zA-Z_][a-zA-Z0-9_.]*)', 1)" for k in text.TABLE_AFTER)


@query(f"WITH {_STATEMENTS}, t AS (SELECT DISTINCT id, unnest({_AFTER}) AS table_name FROM st) SELECT id, table_name FROM t")
def sql_tables(spark, d):
    return statements(spark, d).select("id", F.explode(text.table_names(F.col("sql"))).alias("table_name"))


@query(f"WITH {_STATEMENTS}, c AS (SELECT id, " + ", ".join(f"len(regexp_extract_all(sql, '(?i){p}'))::int AS {n}" for n, p in text.COMPLEX) + " FROM st), t AS (SELECT *, subqueries * 2 + joins + unions * 2 + cases + windows * 3 + ctes * 2 AS total FROM c) SELECT id, subqueries, joins, unions, cases, windows, ctes, CASE WHEN total = 0 THEN 'simple' WHEN total <= 5 THEN 'moderate' WHEN total <= 15 THEN 'complex' ELSE 'very_complex' END AS level FROM t")
def sql_complexity(spark, d):
    rows = statements(spark, d).select("id", *(c.alias(n) for n, c in text.complexity(F.col("sql")).items()))
    return rows.select("*", scoring.complexity_level(*(F.col(n) for n, _ in text.COMPLEX)).alias("level"))


@query(f"WITH {_STATEMENTS} SELECT id, " + ", ".join(f"({_weighted('sql', r)})::bigint AS {k}" for k, r in scoring.DIALECTS.items()) + " FROM st")
def sql_dialects(spark, d):
    return statements(spark, d).select("id", *(v.cast("bigint").alias(k) for k, v in scoring.scores(F.col("sql"), scoring.DIALECTS).items()))


@query(f"WITH {_STATEMENTS} SELECT id, regexp_replace(regexp_extract(sql, '(?is)\\b(?:CREATE|ALTER|DROP)\\s+(?:UNIQUE\\s+)?(?:TABLE|VIEW|INDEX|PROCEDURE|PROC|FUNCTION|TRIGGER)\\s+([\\w.#@]+)', 1), '[\\[\\]]', '', 'g') AS name FROM st")
def sql_objects(spark, d):
    return statements(spark, d).select("id", text.object_name(F.col("sql")).alias("name"))


@query(f"WITH {model.FILES} SELECT doc_id, CASE layer WHEN 'UI' THEN 'screen' WHEN 'Service' THEN 'service' WHEN 'Database' THEN 'service' WHEN 'Integration' THEN 'integration' ELSE 'utility' END AS subdomain_type, 'other' AS file_type, coalesce(layer, 'Other') AS layer FROM files")
def classify_files(spark, d):
    f = model.files(spark, d)
    return f.select("doc_id", classify.subdomain_type(F.col("layer")).alias("subdomain_type"), classify.file_type(paths.extension(F.col("path"))).alias("file_type"), classify.to_layer(F.coalesce("layer", F.lit(""))).alias("layer"))


@query("SELECT conv_id, turn, CASE " + " ".join(f"WHEN contains(lower(text), '{w}') THEN '{c}'" for w, c in classify.ERRORS) + " ELSE 'unknown' END AS error_class FROM conversations")
def error_classes(spark, d):
    return model.table(spark, d, "conversations").select("conv_id", "turn", classify.error_class(F.col("text")).alias("error_class"))


# Extraction


@query("SELECT page_id, " + ", ".join(f"len(regexp_extract_all(html, '(?i)<{t}[^>]*>'))::int AS {t}" for t in extract.ELEMENTS) + " FROM pages")
def html_element_counts(spark, d):
    return model.table(spark, d, "pages").select("page_id", *(c.alias(t) for t, c in extract.element_counts(F.col("html")).items()))


@query(f"WITH {model.LINKS} SELECT page_id, href, count(*) AS n FROM links GROUP BY 1, 2")
def href_links(spark, d):
    return model.page_links(spark, d).groupBy("page_id", "href").agg(F.count("*").alias("n"))


@query("WITH t AS (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<div\\s([^>]*)>', 1)) AS a FROM pages), n AS (SELECT page_id, unnest(regexp_extract_all(a, '([a-zA-Z:-]+)=', 1)) AS name FROM t) SELECT name, count(*) AS n, count(DISTINCT page_id) AS pages FROM n GROUP BY 1")
def attr_names(spark, d):
    rows = model.table(spark, d, "pages").select("page_id", F.explode(extract.attribute_names(F.col("html"), "div")).alias("name"))
    return rows.groupBy("name").agg(F.count("*").alias("n"), F.countDistinct("page_id").alias("pages"))


@query("SELECT page_id, len(regexp_extract_all(html, '(?is)<script[^>]*>(.*?)</script>', 1))::int AS scripts, len(regexp_extract_all(html, '(?is)<style[^>]*>(.*?)</style>', 1))::int AS styles, len(regexp_extract_all(html, '(?s)<!--(.*?)-->', 1))::int AS comments, coalesce(regexp_extract_all(html, '(?is)<script[^>]*>(.*?)</script>', 1)[1], '') AS first_script FROM pages")
def script_blocks(spark, d):
    h = F.col("html")
    s = extract.script_blocks(h)
    return model.table(spark, d, "pages").select("page_id", F.size(s).alias("scripts"), F.size(extract.style_blocks(h)).alias("styles"), F.size(extract.comments(h)).alias("comments"), F.coalesce(F.get(s, F.lit(0)), F.lit("")).alias("first_script"))


@query("SELECT page_id, (len(regexp_extract_all(html, '<!--')) - len(regexp_extract_all(html, '-->')))::int AS open_comments, len(list_filter(string_split(html, chr(10)), lambda x: len(regexp_extract_all(x, '\"')) % 2 = 1))::int AS odd_lines FROM pages")
def syntax_checks(spark, d):
    h = F.col("html")
    return model.table(spark, d, "pages").select("page_id", checks.comment_balance(h).cast("int").alias("open_comments"), checks.odd_quote_lines(h).alias("odd_lines"))


@query("WITH s AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<style[^>]*>(.*?)</style>', 1)) AS css FROM pages), e AS (SELECT page_id, unnest(regexp_extract_all(css, '(?:^|[\\s},])([a-z][a-z0-9]*)\\s*\\{', 1)) AS selector FROM s) SELECT selector, count(DISTINCT page_id) AS pages FROM e GROUP BY 1")
def css_selectors(spark, d):
    css = model.table(spark, d, "pages").select("page_id", F.explode(extract.style_blocks(F.col("html"))).alias("css"))
    rows = css.select("page_id", F.explode(extract.css_selectors(F.col("css"))["elements"]).alias("selector"))
    return rows.groupBy("selector").agg(F.countDistinct("page_id").alias("pages"))


@query("SELECT doc_id, len(regexp_extract_all(text, '[0-9]{4,}'))::int AS n FROM documents WHERE len(regexp_extract_all(text, '[0-9]{4,}')) > 0")
def grep_counts(spark, d):
    return model.table(spark, d, "documents").select("doc_id", F.regexp_count("text", F.lit("[0-9]{4,}")).alias("n")).where("n > 0")


@query("SELECT doc_id, round(len(regexp_extract_all(text, '[\\x01-\\x08\\x0B\\x0C\\x0E-\\x1F]'))::double / greatest(length(text), 1), 6) AS control_share, (len(regexp_extract_all(text, '[\\x01-\\x08\\x0B\\x0C\\x0E-\\x1F]'))::double / greatest(length(text), 1) <= 0.05) AS valid FROM documents")
def encoding_validity(spark, d):
    t = F.col("text")
    return model.table(spark, d, "documents").select("doc_id", F.round(checks.control_share(t), 6).alias("control_share"), checks.is_valid_text(t).alias("valid"))


# Vectors: every vector whose id is divisible by 50 is a query, against all


_NEAR = f"WITH {model.CHUNKS}, p AS (SELECT q.vec_id AS query_id, v.vec_id AS neighbor_id, v.chunk_type, round(list_cosine_similarity(q.embedding, v.embedding), 6) AS score FROM chunks q, chunks v WHERE q.vec_id % 50 = 0)"


def _sides(spark, d):
    c = model.chunks(spark, d)
    both = vectors.indexed(c, "vec_id", "embedding", 64)
    return both.where("vec_id % 50 = 0"), both


@query(_NEAR + ", r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbor_id) AS rank FROM p) SELECT query_id, neighbor_id, score, rank FROM r WHERE rank <= 10 AND query_id <> neighbor_id")
def knn_topk(spark, d):
    q, rows = _sides(spark, d)
    return vectors.knn(q, rows, 10)


@query(_NEAR + ", r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbor_id) AS rank FROM p WHERE chunk_type = '3') SELECT query_id, neighbor_id, score, rank FROM r WHERE rank <= 5 AND query_id <> neighbor_id")
def knn_by_type(spark, d):
    q, rows = _sides(spark, d)
    return vectors.knn(q, rows.where("chunk_type = '3'"), 5)


@query(_NEAR + " SELECT query_id, neighbor_id, score FROM p WHERE score >= 0.3 AND query_id <> neighbor_id")
def cosine_pairs_threshold(spark, d):
    q, rows = _sides(spark, d)
    return vectors.similar(q, rows, 0.3)


@query(_NEAR + ", r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbor_id) AS rank FROM p), n AS (SELECT query_id, count(*) AS n, round(avg(score), 6) AS mean FROM r WHERE rank <= 10 AND query_id <> neighbor_id GROUP BY 1) SELECT query_id, n, mean, CASE WHEN mean > 0.8 AND n >= 3 THEN 0.05 WHEN mean > 0.7 AND n >= 2 THEN 0.035 WHEN mean > 0.6 THEN 0.025 ELSE 0 END::double AS boost FROM n")
def confidence_boost(spark, d):
    q, rows = _sides(spark, d)
    return vectors.boosts(vectors.knn(q, rows, 10)).withColumn("boost", F.round("boost", 6))


@query("SELECT vec_id, round(list_sum(list_transform(embedding[1:32], lambda x: x::double)), 6) AS head, len(embedding)::int AS size FROM embeddings")
def vector_align(spark, d):
    v = vectors.with_dimension(vectors.doubles(F.col("embedding")), 32)
    return model.table(spark, d, "embeddings").select("vec_id", F.round(F.aggregate(v, F.lit(0.0), lambda s, x: s + x), 6).alias("head"), F.size("embedding").alias("size"))


@query("WITH t AS (SELECT count(*) AS total, min(vec_id) AS low FROM embeddings), s AS (SELECT greatest(3, total // 7) AS size, low FROM t) SELECT vec_id, ((vec_id - low) // size)::bigint AS cluster FROM embeddings, s WHERE (vec_id - low) // size < 7")
def cluster_ranges(spark, d):
    return vectors.cluster_ranges(model.table(spark, d, "embeddings"), "vec_id", 7, 3)


@query("SELECT label::varchar AS chunk_type, count(*) AS n, round(count(*) * 64 * 4 / 1048576.0, 6)::double AS mib FROM embeddings GROUP BY 1")
def index_stats(spark, d):
    return model.chunks(spark, d).groupBy("chunk_type").agg(F.count("*").alias("n"), F.round(F.count("*") * 64 * 4 / 1048576.0, 6).alias("mib"))


@query()
def kmeans_clusters(spark, d):
    return vectors.kmeans(model.chunks(spark, d), "embedding", 10).groupBy("cluster").agg(F.count("*").alias("n"))


# Graph


@query(f"WITH {model.RELATIONS} SELECT to_id, count(*) FILTER (type = 'readsFrom') AS reads, count(*) FILTER (type = 'writesTo') AS writes, count(*) FILTER (type = 'deletesFrom') AS deletes FROM relations GROUP BY 1")
def crud_pivot(spark, d):
    return assemble.usage(model.relations(spark, d)).withColumnRenamed("table_name", "to_id")


@query(f"WITH {model.RELATIONS}, c AS (SELECT type, to_id, count(*) AS n FROM relations GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY type ORDER BY n DESC, to_id) AS rank FROM c) SELECT type, to_id, n, rank FROM r WHERE rank <= 5")
def op_top_n(spark, d):
    return aggregate.top_per(model.relations(spark, d).groupBy("type", "to_id").agg(F.count("*").alias("n")), "type", 5, [F.desc("n"), F.col("to_id")])


@query(f"WITH {model.RELATIONS} SELECT type, count(*) FILTER (confidence >= 0.95) AS kept, count(*) FILTER (confidence < 0.95) AS gone FROM relations GROUP BY 1")
def confidence_gate(spark, d):
    r = model.relations(spark, d)
    kept = graph.gated(r, 0.95).groupBy("type").agg(F.count("*").alias("kept"))
    return r.groupBy("type").agg(F.count("*").alias("n")).join(kept, "type", "left").select("type", F.coalesce("kept", F.lit(0)).alias("kept"), (F.col("n") - F.coalesce("kept", F.lit(0))).alias("gone"))


@query(f"WITH {model.RELATIONS}, o AS (SELECT from_id, to_id, type, min(id) AS first_id FROM relations GROUP BY 1, 2, 3) SELECT from_id, to_id, type, first_id FROM o")
def relation_dedup(spark, d):
    r = model.relations(spark, d).select("from_id", "to_id", "type", F.col("id").alias("first_id"), F.col("id").alias("ord"))
    return linking.deduplicated(r, ["from_id", "to_id", "type"], "ord").select("from_id", "to_id", "type", "first_id")


@query(f"WITH {model.ROUTES}, t AS (SELECT page_id, path FROM routes), f AS (SELECT page_id AS target, path, host FROM routes), l AS (SELECT r.page_id, 1 AS rank, min(f.target) AS target FROM routes r JOIN f ON f.host || f.path = r.host || r.path AND f.target <> r.page_id GROUP BY 1 UNION ALL SELECT r.page_id, 2, min(f.target) FROM routes r JOIN (SELECT path, min(target) AS target FROM f WHERE path <> '' GROUP BY 1) f ON f.path = r.path GROUP BY 1) SELECT page_id, arg_min(target, rank) AS target, CASE min(rank) WHEN 1 THEN 'exact' ELSE 'path' END AS tier FROM l GROUP BY 1")
def link_ladder(spark, d):
    r = model.routes(spark, d)
    # Exact: the least other page of the same host and path; else the least page with the same path.
    left, twin = r.select("page_id", "host", "path"), ["host", "path"]
    least = left.groupBy(*twin).agg(F.min("page_id").alias("m1"))
    second = left.join(least, twin).where("page_id != m1").groupBy(*twin).agg(F.min("page_id").alias("m2"))
    exact = left.join(least, twin).join(second, twin).select("page_id", F.when(F.col("page_id") == F.col("m1"), F.col("m2")).otherwise(F.col("m1")).alias("target"), F.lit("exact").alias("tier"))
    rest = left.join(exact.select("page_id"), "page_id", "left_anti")
    right = r.select(F.col("page_id").alias("target"), F.col("path").alias("p")).where("p != ''")
    by_path = linking.ladder(rest, right, [("path", lambda x: F.nullif(F.col("path"), F.lit("")), lambda x: F.col("p"))], "page_id", "target")
    return exact.unionByName(by_path)


@query("SELECT o_orderkey, coalesce('cust_' || c_custkey, 'none') AS class_id FROM orders LEFT JOIN customer ON 'Customer#' || lpad(o_custkey::varchar, 9, '0') = c_name OR c_custkey = o_custkey")
def class_index_join(spark, d):
    c = model.table(spark, d, "customer").select(F.concat(F.lit("cust_"), "c_custkey").alias("class_id"), F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("fqn"), F.col("c_custkey").alias("ord"))
    index = linking.class_index(c)
    o = model.table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("name"))
    return o.join(index, "name", "left").select("o_orderkey", F.coalesce("class_id", F.lit("none")).alias("class_id"))


_MOUNTS = ("en", "fr", "de/1", "de", "es")


@query(f"WITH {model.ROUTES}, m(base) AS (VALUES " + ", ".join(f"('/{m}')" for m in _MOUNTS) + ") SELECT page_id, (SELECT arg_max(base, length(base)) FROM m WHERE path = base OR starts_with(path, base || '/')) AS base FROM routes")
def prefix_mount_join(spark, d):
    mounts = spark.createDataFrame([("/" + m,) for m in _MOUNTS], "base string")
    r = model.routes(spark, d)
    own = linking.prefix_mounts(r.select("path").distinct(), mounts)
    return r.select("page_id", "path").join(own, "path", "left").select("page_id", "base")


@query("SELECT l_orderkey, l_linenumber, coalesce((SELECT min(p_name) FROM part WHERE p_partkey = l_partkey AND p_size > 25), (SELECT min(s_name) FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal > 5000), 'none') AS rule FROM lineitem")
def rule_fallback_join(spark, d):
    li = model.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    p = model.table(spark, d, "part").where("p_size > 25").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    s = model.table(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    out = linking.with_fallbacks(li, [(p, ["l_partkey"], "p_name"), (s, ["l_suppkey"], "s_name")], "rule")
    return out.select("l_orderkey", "l_linenumber", F.coalesce("rule", F.lit("none")).alias("rule"))


@query("WITH ops AS (SELECT DISTINCT 'supp.' || l_suppkey AS proc, CASE l_returnflag WHEN 'A' THEN 'SELECT' WHEN 'R' THEN 'DELETE' ELSE 'UPDATE' END AS op, p_brand AS table_name FROM lineitem JOIN part ON p_partkey = l_partkey), calls AS (SELECT s_name AS method, CASE WHEN s_suppkey % 2 = 0 THEN 'supp.' || s_suppkey ELSE s_suppkey::varchar END AS proc FROM supplier) SELECT DISTINCT method, c.proc, CASE op WHEN 'SELECT' THEN 'readsFrom' WHEN 'DELETE' THEN 'deletesFrom' ELSE 'writesTo' END AS type, table_name, 0.8::double AS confidence FROM calls c JOIN ops o ON o.proc = c.proc OR o.proc = 'supp.' || c.proc")
def proc_expand(spark, d):
    li, p, s = (model.table(spark, d, t) for t in ("lineitem", "part", "supplier"))
    ops = li.join(p, li.l_partkey == p.p_partkey).select(F.concat(F.lit("supp."), "l_suppkey").alias("proc"), F.expr("CASE l_returnflag WHEN 'A' THEN 'SELECT' WHEN 'R' THEN 'DELETE' ELSE 'UPDATE' END").alias("op"), F.col("p_brand").alias("table_name"))
    calls = s.select(F.col("s_name").alias("method"), F.expr("CASE WHEN s_suppkey % 2 = 0 THEN concat('supp.', s_suppkey) ELSE cast(s_suppkey AS string) END").alias("proc"))
    return linking.expanded_calls(calls, linking.procedure_map(ops))


#: Every page is a node; each links up to the page of its section (a quarter of its number) and to the one before it in that.
_EDGES = "edges AS (SELECT page_id AS a, page_id // 4 AS b FROM pages WHERE page_id // 4 <> page_id UNION SELECT page_id, page_id // 4 - 1 FROM pages WHERE page_id % 16 = 0 AND page_id > 15)"


def _edges(spark, d):
    p = model.table(spark, d, "pages")
    up = p.selectExpr("page_id AS a", "page_id DIV 4 AS b").where("a != b")
    return up.unionByName(p.where("page_id % 16 = 0 AND page_id > 15").selectExpr("page_id AS a", "page_id DIV 4 - 1 AS b")).distinct()


@query(f"WITH RECURSIVE {_EDGES}, r AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM r JOIN edges e ON r.b = e.a) SELECT a, b FROM r WHERE a <> b")
def role_closure(spark, d):
    return graph.closure(_edges(spark, d)).select("a", "b")


@query(f"WITH RECURSIVE {_EDGES}, r AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM r JOIN edges e ON r.b = e.a) SELECT DISTINCT a, 'role_' || b % 5 AS role FROM r WHERE a <> b")
def role_propagation(spark, d):
    e = _edges(spark, d)
    owners = e.select(F.col("b").alias("node")).distinct().withColumn("role", F.concat(F.lit("role_"), F.col("node") % 5))
    return graph.propagated(owners, graph.closure(e))


@query(f"WITH {model.RELATIONS} SELECT from_id, coalesce(string_agg(DISTINCT to_id, ',' ORDER BY to_id) FILTER (type = 'readsFrom'), '') AS \"readsFrom\", coalesce(string_agg(DISTINCT to_id, ',' ORDER BY to_id) FILTER (type = 'writesTo'), '') AS \"writesTo\", coalesce(string_agg(DISTINCT to_id, ',' ORDER BY to_id) FILTER (type = 'deletesFrom'), '') AS \"deletesFrom\" FROM relations GROUP BY 1")
def trace_rollup(spark, d):
    return graph.crud_summary(model.relations(spark, d), "from_id")


@query(f"WITH {model.RELATIONS} SELECT type, count(DISTINCT from_id) AS covered, count(*) AS edges, round(count(DISTINCT from_id)::double / (SELECT count(*) FROM customer), 6) AS share FROM relations GROUP BY 1")
def coverage_stats(spark, d):
    return graph.coverage(model.table(spark, d, "customer"), model.relations(spark, d), ["readsFrom", "writesTo", "deletesFrom"])


@query(f"WITH {model.RELATIONS} SELECT 'order_' || o_orderkey AS id FROM orders WHERE NOT EXISTS (SELECT 1 FROM relations WHERE order_key = o_orderkey AND type IN ('readsFrom', 'deletesFrom'))")
def unlinked(spark, d):
    o = model.table(spark, d, "orders").select(F.concat(F.lit("order_"), "o_orderkey").alias("id"))
    return linking.unlinked(o, model.relations(spark, d).withColumn("from_id", F.concat(F.lit("order_"), "order_key")), ["readsFrom", "deletesFrom"])


@query(f"WITH {model.RELATIONS}, e AS (SELECT from_id AS id FROM relations UNION SELECT to_id FROM relations) SELECT id, string_split(id, '_')[1] AS type FROM e WHERE id NOT IN (SELECT 'part_' || p_partkey FROM part WHERE p_size > 10) AND id NOT IN (SELECT 'customer_' || c_custkey FROM customer)")
def stub_entities(spark, d):
    p = model.table(spark, d, "part").where("p_size > 10").select(F.concat(F.lit("part_"), "p_partkey").alias("id"))
    c = model.table(spark, d, "customer").select(F.concat(F.lit("customer_"), "c_custkey").alias("id"))
    return graph.stubs(model.relations(spark, d), p.unionByName(c))


@query(f"WITH {model.RELATIONS} SELECT id FROM relations WHERE ('0x' || substr(md5(id), 1, 8))::bigint % 10000000 / 1e7 < 0.1")
def evidence_sampling(spark, d):
    return graph.sampled(model.relations(spark, d), "id", 0.1).select("id")


@query()
def page_chains(spark, d):
    e = _edges(spark, d).select(F.col("a").alias("from_id"), F.col("b").alias("to_id"), (F.col("b") % 3).alias("rank"))
    starts = e.select(F.col("from_id").alias("start")).distinct()
    return graph.chain(starts, e).select("start", "node", "level", "ord")


# Assembly, gates, rendering


_SEGMENTED = f"{model.ROUTES}, d AS (SELECT id, path, list_filter(string_split(lower(path), '/'), lambda x: x <> '') AS s FROM routes), m AS (SELECT id, path, coalesce({_BY(1)}, {_BY(2)}, CASE WHEN length(s[1]) > 2 THEN s[1] END, 'general') AS domain FROM d)"


#: Pages as routes of twenty areas and of domains of their own; tables read by every third, roles of every fourth page.
_AREAS = "m AS (SELECT 'page_' || page_id AS id, CASE WHEN page_id % 2 = 0 THEN 'area' || page_id % 20 ELSE 'solo' || page_id END AS domain FROM pages)"
_ROUTE_RELATIONS = "rel AS (SELECT 'page_' || page_id AS id, 'table_t' || page_id % 35 AS to_id, 'readsFrom' AS type FROM pages WHERE page_id % 3 = 0 UNION ALL SELECT 'page_' || page_id, 'role_' || page_id % 22, 'securedBy' FROM pages WHERE page_id % 4 = 0)"


def _areas(spark, d):
    p, key = model.table(spark, d, "pages"), F.col("page_id")
    return p.select(F.concat(F.lit("page_"), key).alias("id"), F.when(key % 2 == 0, F.concat(F.lit("/area"), key % 20, F.lit("/x"))).otherwise(F.concat(F.lit("/solo"), key)).alias("path"))


def _route_relations(spark, d):
    p = model.table(spark, d, "pages")
    edge = lambda rows, to, kind: rows.select(F.concat(F.lit("page_"), "page_id").alias("from_id"), F.concat(*to).alias("to_id"), F.lit(kind).alias("type"), F.lit(0.9).alias("confidence"))
    return edge(p.where("page_id % 3 = 0"), (F.lit("table_t"), F.col("page_id") % 35), "readsFrom").unionByName(edge(p.where("page_id % 4 = 0"), (F.lit("role_"), F.col("page_id") % 22), "securedBy"))


@query(
    f"WITH {_AREAS}, {_ROUTE_RELATIONS} SELECT 'cap_domain_' || domain AS id, domain, count(DISTINCT m.id) AS members, round(least(0.99, 0.4 + 0.05 * count(DISTINCT m.id))::double, 6) AS confidence, "
    "coalesce(string_agg(DISTINCT CASE WHEN type = 'readsFrom' THEN to_id[7:] END, ',' ORDER BY CASE WHEN type = 'readsFrom' THEN to_id[7:] END), '') AS tables, "
    "coalesce(string_agg(DISTINCT CASE WHEN type = 'securedBy' THEN to_id END, ',' ORDER BY CASE WHEN type = 'securedBy' THEN to_id END), '') AS roles, count(to_id) AS citations FROM m LEFT JOIN rel USING (id) GROUP BY domain"
)
def capability_groups(spark, d):
    found = assemble.capabilities(_areas(spark, d), _route_relations(spark, d))
    return found.select("id", "domain", "members", F.round("confidence", 6).alias("confidence"), F.array_join("tables", ",").alias("tables"), F.array_join("roles", ",").alias("roles"), "citations")


@query()
def capability_merged(spark, d):
    found = assemble.capabilities(_areas(spark, d), _route_relations(spark, d), merge=True)
    return found.select("id", "domain", "members", F.array_join("tables", ",").alias("tables"), F.array_join("roles", ",").alias("roles"), "citations")


@query("SELECT coalesce(lang, 'Unclassified') AS section, '## ' || coalesce(lang, 'Unclassified') || chr(10) || chr(10) || '| source | n |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || source || ' | ' || n || ' |', chr(10) ORDER BY source) AS body FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2) GROUP BY 1")
def domain_sections(spark, d):
    g = model.table(spark, d, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))
    return render.domain_sections(g, "lang", "Sources", ["source", "n"], ["source"])


@query("WITH m AS (SELECT avg((l.doc_id IS NOT NULL)::int)::double AS parse_success, avg((n_chars > 1000)::int)::double AS route_resolution, avg((n_chars < 100)::int)::double AS unresolved, avg(coalesce(quality, 0))::double AS cohesion FROM documents d LEFT JOIN labels l USING (doc_id)) SELECT gate, round(value, 6) AS value, threshold, CASE WHEN gate = 'unresolved' THEN round(value, 6) <= threshold ELSE round(value, 6) >= threshold END AS ok FROM (SELECT 'parse_success' AS gate, parse_success AS value, 0.7::double AS threshold FROM m UNION ALL SELECT 'route_resolution', route_resolution, 0.5::double FROM m UNION ALL SELECT 'unresolved', unresolved, 0.2::double FROM m UNION ALL SELECT 'cohesion', cohesion, 0.5::double FROM m)")
def gates_table(spark, d):
    docs, labels = model.table(spark, d, "documents"), model.table(spark, d, "labels").withColumn("has", F.lit(1))
    j = docs.select("doc_id", "n_chars").join(labels, "doc_id", "left")
    m = j.agg(F.avg(F.coalesce("has", F.lit(0))).alias("parse_success"), F.avg((F.col("n_chars") > 1000).cast("int")).alias("route_resolution"), F.avg((F.col("n_chars") < 100).cast("int")).alias("unresolved"), F.avg(F.coalesce("quality", F.lit(0))).alias("cohesion"))
    return gates.gate_rows(m)


@query(f"WITH {model.FILES} SELECT doc_id, 'large' AS issue FROM files WHERE size_bytes > 8000 UNION ALL SELECT doc_id, 'no_layer' FROM files WHERE layer IS NULL UNION ALL SELECT doc_id, 'shouting' FROM files WHERE list_contains(framework_hints, 'shout')")
def quality_flags(spark, d):
    f = model.files(spark, d)
    return gates.flagged(f, {"large": F.col("size_bytes") > 8000, "no_layer": F.col("layer").isNull(), "shouting": F.array_contains("framework_hints", "shout")}, "doc_id")


@query(f"WITH {model.FILES}, a AS (SELECT source_location, count(*) AS declared FROM files GROUP BY 1), b AS (SELECT source_location, count(*) AS counted FROM files WHERE size_bytes > 50 GROUP BY 1) SELECT coalesce(a.source_location, b.source_location) AS source_location, declared, counted FROM a FULL JOIN b USING (source_location) WHERE coalesce(declared, 0) <> coalesce(counted, 0)")
def count_consistency(spark, d):
    f = model.files(spark, d)
    count = lambda x: x.groupBy("source_location").agg(F.count("*").alias("n"))
    return gates.count_mismatch(count(f), count(f.where("size_bytes > 50")), "source_location")


@query(f"WITH {model.FILES} SELECT language, count(*) AS n, count(*) FILTER (layer IS NULL OR layer NOT IN ('UI', 'Service', 'Database')) AS n_outside, count(*) FILTER (layer IS NULL OR layer NOT IN ('UI', 'Service', 'Database')) <= 0.2 * count(*) AS ok FROM files WHERE language IN ('en', 'fr') GROUP BY 1")
def layer_rules(spark, d):
    f = model.files(spark, d).withColumn("layer", F.coalesce("layer", F.lit("none")))
    layers = ["UI", "Service", "Database"]
    return gates.layer_rules(f, {"en": layers, "fr": layers})


@query("SELECT count(*) AS processed, count(*) FILTER (event_type = 'error') AS failed, count(*) FILTER (event_type <> 'error') AS ok, round(count(*) FILTER (event_type <> 'error')::double / count(*), 6) AS success, round(count(*)::double / (floor(epoch(max(ts))) - floor(epoch(min(ts)))), 6) AS rate FROM events")
def progress_summary(spark, d):
    return progress.batch_summary(model.table(spark, d, "events"), F.col("event_type") == "error")


@query("WITH b AS (SELECT DISTINCT text AS k FROM benchmark), t AS (SELECT DISTINCT text AS k FROM documents) SELECT (SELECT count(*) FROM (SELECT k FROM b INTERSECT SELECT k FROM t)) AS both_sides, (SELECT count(*) FROM (SELECT k FROM b EXCEPT SELECT k FROM t)) AS only_benchmark, (SELECT count(*) FROM b) AS total")
def accuracy_overlap(spark, d):
    b = model.table(spark, d, "benchmark").select(F.col("text").alias("k")).distinct()
    t = model.table(spark, d, "documents").select(F.col("text").alias("k")).distinct()
    row = lambda df, name: df.agg(F.count("*").alias(name))
    return row(b.intersect(t), "both_sides").crossJoin(row(b.subtract(t), "only_benchmark")).crossJoin(row(b, "total"))


# Reports


@query(f"WITH {model.ROUTES}, s AS (SELECT list_filter(string_split(path, '/'), lambda x: x <> '') AS p FROM routes), k AS (SELECT 1 AS level, p[1] AS key FROM s UNION ALL SELECT 2, CASE WHEN len(p) > 1 THEN p[1] || '/' || p[2] END FROM s) SELECT level, key, count(*) AS n FROM k WHERE key IS NOT NULL GROUP BY 1, 2")
def segment_report(spark, d):
    return reports.segments(model.routes(spark, d), F.col("path"))


@query(f"WITH {_SEGMENTED} SELECT domain, count(*) AS n FROM m GROUP BY 1")
def domain_report(spark, d):
    return reports.by_domain(model.routes(spark, d), F.col("path"))


@query("WITH c AS (SELECT CASE WHEN contains(url, '/en/') THEN 'english' WHEN starts_with(url, 'https') THEN 'secure' ELSE 'other' END AS category FROM pages) SELECT category, count(*) AS n, round(100.0::double * count(*) / (SELECT count(*) FROM c), 2) AS percent FROM c GROUP BY 1")
def category_report(spark, d):
    return reports.categorized(model.table(spark, d, "pages"), [("english", F.contains("url", F.lit("/en/"))), ("secure", F.startswith("url", F.lit("https")))])


@query(f"WITH {model.RELATIONS}, e AS (SELECT 'customer_' || c_custkey AS id, c_mktsegment AS type FROM customer UNION ALL SELECT 'part_' || p_partkey, p_brand FROM part) SELECT a.type AS from_type, r.type, b.type AS to_type, count(*) AS n FROM relations r JOIN e a ON a.id = from_id JOIN e b ON b.id = to_id GROUP BY 1, 2, 3")
def endpoint_report(spark, d):
    c = model.table(spark, d, "customer").select(F.concat(F.lit("customer_"), "c_custkey").alias("id"), F.col("c_mktsegment").alias("type"))
    p = model.table(spark, d, "part").select(F.concat(F.lit("part_"), "p_partkey").alias("id"), F.col("p_brand").alias("type"))
    return reports.endpoints(model.relations(spark, d), c.unionByName(p))


@query("SELECT DISTINCT o_orderpriority AS value FROM orders ORDER BY 1 LIMIT 200")
def distinct_values(spark, d):
    return reports.distinct_values(model.table(spark, d, "orders"), "o_orderpriority")


@query(f"WITH {model.RELATIONS}, k AS (SELECT id, type FROM relations WHERE confidence >= 0.97) SELECT type, count(*) AS n FROM relations WHERE id NOT IN (SELECT id FROM k) GROUP BY 1")
def relation_audit(spark, d):
    r = model.relations(spark, d)
    return gates.relation_audit(r, graph.gated(r, 0.97))


@query("SELECT 'customer_' || c_custkey AS from_id, 'role_' || c_mktsegment AS to_id, 'securedBy' AS type, 0.9::double AS confidence FROM customer")
def role_edges(spark, d):
    c = model.table(spark, d, "customer").select(F.concat(F.lit("customer_"), "c_custkey").alias("source_id"), F.lit("class").alias("place"), F.concat(F.lit("ROLE_"), "c_mktsegment").alias("role"))
    return security.role_edges(c).select("from_id", "to_id", "type", "confidence")


@query("WITH r AS (SELECT c_mktsegment AS role, count(*) AS n, min('customer_' || c_custkey) AS example FROM customer GROUP BY 1) SELECT role, n, example, CASE WHEN role = upper(role) THEN 'constant' ELSE 'named' END AS category FROM r ORDER BY n DESC, role LIMIT 10")
def security_summary(spark, d):
    return security.summary(role_edges(spark, d))


@query(f"WITH {model.ROUTES}, {model.LINKS}, r AS (SELECT DISTINCT 'w_' || page_id AS id, path AS action FROM routes), k AS (SELECT id, regexp_replace(regexp_replace(action, '[.](?:do|action|jsp)$', ''), '^/+|/+$', '', 'g') AS k FROM r), called AS (SELECT page_id - 1 AS page_id, CASE page_id % 3 WHEN 0 THEN path || '.do?x=1' WHEN 1 THEN '/lost' || path ELSE path || '/none' END AS href FROM routes WHERE page_id > 0 UNION ALL SELECT page_id, href FROM links), t AS (SELECT DISTINCT 'page_' || page_id AS page, href, regexp_replace(regexp_replace(regexp_replace(href, '[?#;].*$', ''), '[.](?:do|action|jsp)$', ''), '^/+|/+$', '', 'g') AS k FROM called), e AS (SELECT page, href, min(id) AS id FROM t JOIN k USING (k) WHERE k <> '' GROUP BY 1, 2), s AS (SELECT page, href, min(b.id) AS id FROM t JOIN k b ON b.k <> '' AND t.k <> '' AND regexp_extract(b.k, '([^/]*)$', 1) = regexp_extract(t.k, '([^/]*)$', 1) WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.page = t.page AND e.href = t.href) GROUP BY 1, 2) SELECT page AS from_id, id AS to_id, 'equal' AS tier, count(*) AS n FROM e GROUP BY 1, 2 UNION ALL SELECT page, id, 'segment', count(*) FROM s GROUP BY 1, 2")
def page_calls(spark, d):
    r = model.routes(spark, d).select(F.concat(F.lit("w_"), "page_id").alias("id"), F.col("path").alias("action")).distinct()
    #: Each page calls the one after it: by its path with an ending, below another folder, or not at all.
    p = model.routes(spark, d).where("page_id > 0")
    href = F.when(F.col("page_id") % 3 == 0, F.concat("path", F.lit(".do?x=1"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("/lost"), "path")).otherwise(F.concat("path", F.lit("/none")))
    t = p.select(F.concat(F.lit("page_"), F.col("page_id") - 1).alias("page"), href.alias("token"))
    #: And each calls what the links of its text lead to.
    t = t.unionByName(model.page_links(spark, d).select(F.concat(F.lit("page_"), "page_id").alias("page"), F.col("href").alias("token")))
    return pages.calls(t, r).groupBy("from_id", "to_id", "tier").agg(F.count("*").alias("n"))


@query(f"WITH {_STATEMENTS}, t AS (SELECT id, unnest(regexp_extract_all(sql, '(?i)\\b(?:FROM|JOIN|INTO|UPDATE)\\s+([\\w.#]+)', 1)) AS t FROM st) SELECT DISTINCT id, t AS table_name FROM t WHERE length(t) > 2")
def sql_touched(spark, d):
    return statements(spark, d).select("id", F.explode(ddl.tables_of(F.col("sql"))).alias("table_name"))


@query(f"SELECT p_partkey AS id, 'hr.people' || p_size AS name, unnest(['id', 'at']) AS column_name, unnest(['INT', 'DATETIME']) AS type, unnest([NULL, 'GETDATE()']) AS \"default\" FROM part WHERE p_partkey % {len(STATEMENTS)} = 4")
def ddl_columns(spark, d):
    rows = statements(spark, d).select("id", ddl.table_of(F.col("sql")).alias("t")).where("t.name IS NOT NULL")
    return rows.select("id", "t.name", F.explode("t.columns").alias("c")).select("id", "name", F.col("c.name").alias("column_name"), F.col("c.type").alias("type"), F.col("c.default").alias("default"))


WEB_XML = """<web-app xmlns="x"><servlet><servlet-name>a</servlet-name><servlet-class>c.Old</servlet-class></servlet><servlet><servlet-name>a</servlet-name><servlet-class>c.A{n}</servlet-class></servlet>
<servlet-mapping><servlet-name>a</servlet-name><url-pattern>/a{n}/*</url-pattern></servlet-mapping><servlet-mapping><servlet-name>missing</servlet-name><url-pattern>/m</url-pattern></servlet-mapping>
<filter><filter-name>f</filter-name><filter-class>c.F{n}</filter-class></filter><filter><filter-name>g</filter-name><filter-class>c.G</filter-class></filter><filter-mapping><filter-name>f</filter-name><url-pattern>/*</url-pattern></filter-mapping>
<error-page><error-code>404</error-code><location>/e.jsp</location></error-page><session-config><session-timeout>30</session-timeout></session-config></web-app>"""


def _filled(spark, d, text: str, ending: str):
    """A document a supplier: path, text with the supplier's key in place of {n}."""
    key = F.col("s_suppkey").cast("string")
    return model.table(spark, d, "supplier").select(F.concat(F.lit("s"), key, F.lit(ending)).alias("path"), F.replace(F.lit(text), F.lit("{n}"), key).alias("text"))


@query("SELECT unnest(['/a' || s_suppkey || '/*', '/*', 'g', '404']) AS from_reference, unnest(['c.A' || s_suppkey, 'c.F' || s_suppkey, 'c.G', '/e.jsp']) AS to_reference, unnest(['servlet', 'filter', 'filter', 'exception']) AS mapping_type FROM supplier")
def config_mappings(spark, d):
    docs = _filled(spark, d, WEB_XML, "/web.xml")
    return configs.servlet_mappings(docs).unionByName(configs.filter_mappings(docs)).unionByName(configs.error_pages(docs)).select("from_reference", "to_reference", "mapping_type")


CODE = '''package a.b;
@Path("/emp{n}") @Service
public class Emp{n} extends Base{n} implements Run {
  @Autowired private EmpManager manager;
  @OneToMany(mappedBy = "x") private List<Order> orders;
  @RolesAllowed({"A", "B"}) @GET @Path("/all") public String all() { Util.go{n}(); return "SELECT a FROM t"; }
}'''


@query("SELECT 'a.b.Emp' || s_suppkey AS from_reference, unnest(['extends', 'implements', 'injects', 'OneToMany', 'component', 'static_call', 'secured', 'secured']) AS mapping_type, unnest(['Base' || s_suppkey, 'Run', 'EmpManager', 'Order', 'Service', 'Util.go' || s_suppkey, 'A', 'B']) AS to_reference FROM supplier")
def code_edges(spark, d):
    return code.code_mappings(_filled(spark, d, CODE, "/Emp.java")).select("from_reference", "mapping_type", "to_reference").distinct()


@query("SELECT 's' || s_suppkey || '/Emp.java' AS path, 'GET' AS verb, '/emp' || s_suppkey || '/all' AS full_path, 'all' AS method FROM supplier")
def code_endpoints(spark, d):
    return code.endpoints(code.typed(_filled(spark, d, CODE, "/Emp.java"))).select("path", "verb", "full_path", "method")


# Streams


@query("SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS day, count(*) AS processed, count(*) FILTER (event_type = 'error') AS failed FROM events GROUP BY 1")
def stream_progress(spark, d):
    schema = model.table(spark, d, "events").schema
    # A pattern, as a plain path would have to be a folder.
    events = spark.readStream.schema(schema).parquet(f"{d}/event[s].parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    counts = progress.stream_counts(events, F.col("event_type") == "error")
    return progress.drained(counts, "stream_progress").select(F.date_format("start", "yyyy-MM-dd").alias("day"), "processed", "failed")


# Single operators: filters, lookups and names that the queries above use only together


def _files(spark, d):
    return inventory.files(model.files(spark, d))


@query(f"WITH {model.FILES} SELECT doc_id, size_bytes FROM files WHERE size_bytes >= 5000")
def inv_min_size(spark, d):
    return _files(spark, d).min_size(5000).execute().select("doc_id", "size_bytes")


@query(f"WITH {model.FILES} SELECT doc_id, size_bytes FROM files WHERE size_bytes <= 300")
def inv_max_size(spark, d):
    return _files(spark, d).max_size(300).execute().select("doc_id", "size_bytes")


@query(f"WITH {model.FILES} SELECT doc_id, functional_name FROM files WHERE contains(functional_name, '_1')")
def inv_functional_name(spark, d):
    return _files(spark, d).functional_name_contains("_1").execute().select("doc_id", "functional_name")


@query(f"WITH {model.RELATIONS} SELECT id, confidence FROM relations WHERE confidence >= 0.98")
def inv_min_confidence(spark, d):
    return inventory.files(model.relations(spark, d)).min_confidence(0.98).execute().select("id", "confidence")


@query(f"WITH {model.RELATIONS} SELECT id, confidence FROM relations WHERE confidence <= 0.91")
def inv_max_confidence(spark, d):
    return inventory.files(model.relations(spark, d)).max_confidence(0.91).execute().select("id", "confidence")


@query(f"WITH {model.FILES} SELECT doc_id FROM files WHERE doc_id % 7 = 3")
def inv_where(spark, d):
    return _files(spark, d).where(F.col("doc_id") % 7 == 3).execute().select("doc_id")


@query(f"WITH {model.FILES} SELECT doc_id, path FROM files WHERE language IN ('de', 'fr') AND size_bytes BETWEEN 500 AND 4000 AND ends_with(path, '5.txt')")
def inv_execute(spark, d):
    return _files(spark, d).language("de").language("fr").min_size(500).max_size(4000).path_endswith("5.txt").execute().select("doc_id", "path")


@query(f"WITH {model.FILES} SELECT doc_id, path, size_bytes FROM files ORDER BY size_bytes DESC, path LIMIT 1")
def inv_first(spark, d):
    return _files(spark, d).execute().transform(lambda df: inventory.files(df.withColumn("less", -F.col("size_bytes"))).first("less", "path")).select("doc_id", "path", "size_bytes")


_MAPPED = "g AS (SELECT o_custkey, o_orderpriority AS mapping_type, o_orderkey AS target FROM orders)"


def _mapped(spark, d, kind):
    """Orders of a customer as the mappings of a group, by kind."""
    o = model.table(spark, d, "orders").select("o_custkey", F.struct(F.col("o_orderpriority").alias("mapping_type"), F.col("o_orderkey").alias("target")).alias("m"))
    groups = o.groupBy(F.concat(F.lit("group_"), "o_custkey").alias("group_name")).agg(F.collect_list("m").alias("mappings"))
    return inventory.mappings_of(groups, kind).select("group_name", "target")


@query(f"WITH {_MAPPED} SELECT 'group_' || o_custkey AS group_name, target FROM g WHERE mapping_type = '1-URGENT'")
def inv_action_mappings(spark, d):
    return _mapped(spark, d, "1-URGENT")


@query(f"WITH {_MAPPED} SELECT 'group_' || o_custkey AS group_name, target FROM g WHERE mapping_type = '2-HIGH'")
def inv_forward_mappings(spark, d):
    return _mapped(spark, d, "2-HIGH")


@query("SELECT p_partkey, p_brand, p_size FROM part WHERE p_brand = 'Brand#13' AND p_type = (SELECT min(p_type) FROM part WHERE p_brand = 'Brand#13')")
def inv_lookup(spark, d):
    p = model.table(spark, d, "part")
    kind = p.where("p_brand = 'Brand#13'").agg(F.min("p_type").alias("p_type"))
    return inventory.lookup(p.join(F.broadcast(kind), "p_type", "left_semi"), p_brand="Brand#13").select("p_partkey", "p_brand", "p_size")


@query("SELECT page_id, regexp_replace(trim(coalesce(url, '')), '[?#].*$', '') AS target FROM pages")
def name_clean_target(spark, d):
    return model.table(spark, d, "pages").select("page_id", paths.clean_target(F.coalesce("url", F.lit(""))).alias("target"))


@query(f"WITH {model.FILES} SELECT doc_id FROM files WHERE regexp_full_match(path, '(?s).*/e.*1\\.txt')")
def name_glob(spark, d):
    return model.files(spark, d).where(paths.matches_glob(F.col("path"), "*/e*1.txt")).select("doc_id")


@query(f"WITH {model.FILES} SELECT doc_id FROM files WHERE contains(path, 'web') OR contains(path, '/de/')")
def name_excluded(spark, d):
    return model.files(spark, d).where(paths.excluded(F.col("path"), ["**/web*", "*web/**"]) | F.contains("path", F.lit("/de/"))).select("doc_id")


@query(f"WITH {model.FILES} SELECT doc_id, replace(regexp_replace(path, '/?[^/]*$', ''), '/', '.') AS package FROM files")
def name_package(spark, d):
    return model.files(spark, d).select("doc_id", paths.package_name(F.col("path")).alias("package"))


@query(f"WITH {model.FILES}, s AS (SELECT doc_id, string_split(path, '/') AS p FROM files) SELECT doc_id, CASE WHEN list_position(p, source) > 0 AND list_position(p, source) < len(p) THEN p[list_position(p, source) + 1] ELSE p[-1] END AS component FROM s, (SELECT min(source) AS source FROM documents)")
def name_component(spark, d):
    first = model.table(spark, d, "documents").agg(F.min("source")).first()[0]
    return model.files(spark, d).select("doc_id", paths.component_after(F.split("path", "/"), f"**/{first}/*").alias("component"))


@query("SELECT c_custkey, nullif(trim(c_name), '') AS name FROM customer")
def name_blank_to_null(spark, d):
    return model.table(spark, d, "customer").select("c_custkey", text.nz(F.col("c_name")).alias("name"))


@query("SELECT c_custkey, CASE WHEN nullif(trim(c_mktsegment), '') IS NOT NULL THEN regexp_replace(regexp_replace(trim(c_mktsegment), '(?i)^role_', ''), '[^A-Za-z0-9_:.-]+', '', 'g') END AS role FROM customer")
def name_role(spark, d):
    return model.table(spark, d, "customer").select("c_custkey", text.canonical_role(F.col("c_mktsegment")).alias("role"))


@query("SELECT DISTINCT c_custkey, r.role AS role FROM (SELECT c_custkey, unnest(list_filter(string_split_regex(c_mktsegment || ',' || c_name || ',' || c_mktsegment, '[,\\s]+'), lambda x: x <> '')) AS role FROM customer) r")
def name_split_roles(spark, d):
    c = model.table(spark, d, "customer")
    return c.select("c_custkey", F.explode(text.split_roles(F.concat_ws(",", "c_mktsegment", "c_name", "c_mktsegment"))).alias("role"))


@query("SELECT p_partkey, CASE WHEN p_brand = upper(p_brand) THEN 'x' ELSE 'y' END AS shape, lower(trim(string_split(regexp_replace(p_name || '.' || p_brand, '\\(.*$', ''), '.')[-1])) AS token FROM part")
def name_object_token(spark, d):
    p = model.table(spark, d, "part")
    return p.select("p_partkey", F.when(F.col("p_brand") == F.upper("p_brand"), "x").otherwise("y").alias("shape"), paths.object_token(F.concat_ws(".", "p_name", "p_brand")).alias("token"))


@query("SELECT doc_id, trim(regexp_replace(regexp_replace(text, '/\\*(?s:.*?)\\*/', ' ', 'g'), '--[^\\r\\n]*', '', 'g'), ' ') AS cleaned FROM documents")
def name_clean_statement(spark, d):
    return model.table(spark, d, "documents").select("doc_id", text.clean_statement(F.col("text")).alias("cleaned"))


@query("SELECT n_nationkey, '### ' || n_name AS title, '| ' || n_nationkey || ' | ' || n_name || ' | - |' AS line FROM nation")
def doc_headings_and_rows(spark, d):
    n = model.table(spark, d, "nation")
    return n.select("n_nationkey", text.heading(F.col("n_name"), 3).alias("title"), text.markdown_row(F.col("n_nationkey"), F.col("n_name"), F.lit(None)).alias("line"))


@query("SELECT p_partkey, 'route_' || replace(replace(trim(p_brand) || '_' || p_type, '/', '_'), '*', 'STAR') AS route FROM part")
def name_route(spark, d):
    return model.table(spark, d, "part").select("p_partkey", paths.route_id(F.col("p_brand"), F.col("p_type")).alias("route"))


@query("SELECT page_id, 'route_' || regexp_replace(url, '[^A-Za-z0-9]+', '_', 'g') || '_GET' AS route FROM pages")
def name_rest_route(spark, d):
    return model.table(spark, d, "pages").select("page_id", paths.rest_route_id(F.col("url"), F.lit("get")).alias("route"))


@query("SELECT name, min(class_id) AS class_id FROM (SELECT 'class_' || s_suppkey AS class_id, unnest(['S' || s_nationkey, 'org.S' || s_suppkey]) AS name, lpad(s_suppkey::varchar, 9, '0') AS ord FROM supplier) t WHERE ord = (SELECT min(ord) FROM (SELECT unnest(['S' || s_nationkey, 'org.S' || s_suppkey]) AS name, lpad(s_suppkey::varchar, 9, '0') AS ord FROM supplier) u WHERE u.name = t.name) GROUP BY 1")
def link_class_index(spark, d):
    s = model.table(spark, d, "supplier")
    return linking.class_index(s.select(F.concat(F.lit("class_"), "s_suppkey").alias("class_id"), F.concat(F.lit("S"), "s_nationkey").alias("name"), F.concat(F.lit("org.S"), "s_suppkey").alias("fqn"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0").alias("ord"))).select("name", "class_id")


@query("WITH r AS (SELECT DISTINCT o_custkey, o_orderpriority AS m, CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '1-URGENT' THEN 2 END AS r FROM orders) SELECT 'class_' || o_custkey AS class_id, coalesce(arg_min(m, r) FILTER (r IS NOT NULL), min(m)) AS method FROM r GROUP BY o_custkey HAVING count(r) > 0 OR count(*) = 1")
def link_chosen_method(spark, d):
    o = model.table(spark, d, "orders").select(F.concat(F.lit("class_"), "o_custkey").alias("class_id"), F.col("o_orderpriority").alias("method")).distinct()
    return linking.chosen_method(o, F.lit("5-LOW"), ["2-HIGH", "1-URGENT"])


@query(f"WITH {model.RELATIONS} SELECT from_id, to_id, type, min(id) AS id FROM relations GROUP BY 1, 2, 3")
def link_first_of_each(spark, d):
    r = model.relations(spark, d).select("from_id", "to_id", "type", "id", "confidence")
    return linking.deduplicated(r, ["from_id", "to_id", "type"], "id").select("from_id", "to_id", "type", "id")


@query(f"WITH {model.RELATIONS}, l AS (SELECT from_id, max({{'id': id, 'to_id': to_id, 'confidence': confidence}}) AS m FROM relations GROUP BY 1) SELECT from_id, m.id AS id, m.to_id AS to_id, m.confidence AS confidence FROM l")
def link_last_wins(spark, d):
    r = model.relations(spark, d).select("from_id", "id", "to_id", "confidence")
    return linking.last_wins(r, ["from_id"], F.struct("id", "to_id", "confidence"))


@query("SELECT c_custkey, ('0x' || substr(md5(c_custkey::varchar), 1, 8))::bigint % 10000000 / 1e7 AS fraction FROM customer")
def score_hash_fraction(spark, d):
    return model.table(spark, d, "customer").select("c_custkey", text.hash_fraction(F.col("c_custkey")).alias("fraction"))


@query("SELECT o_orderkey, coalesce(CASE lower(o_orderstatus) WHEN 'f' THEN 'F' WHEN 'o' THEN 'O' END, 'other') AS status FROM orders")
def class_cast_to_domain(spark, d):
    return model.table(spark, d, "orders").select("o_orderkey", classify.cast_to(F.col("o_orderstatus"), ("F", "O"), "other").alias("status"))


# Queries of their own modules add themselves
from sparkloom.plans import catalog_checks, catalog_code, catalog_config, catalog_names  # noqa: E402, F401
