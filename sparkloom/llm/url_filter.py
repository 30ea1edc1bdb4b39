"""URL filters: a blocked Bloom filter passes possible hits to an exact hash join.

The list is a table of URL prefixes (host, path, verdict) in canonical form. An entry
fits its host and all subdomains when the path starts with the entry's path. Rules
meet URLs as they stand (host in lower case); entries of the list meet canonical URLs:
without user, port and final dot in the host, without repeated slashes, `/` for an
empty path. Each URL proposes only the host suffixes and path prefixes whose lengths
occur in the list; the Bloom filter drops nearly all proposals before the join, which
removes false positives. The join is against a broadcast up to BROADCAST entries; a
longer list meets the proposals in a shuffle in which frequent entries are spread.

Defined results: a null URL or one without "://" has an empty host and path and fits
nothing. URLs are judged once each, so repeated rows agree; frequent URLs, and null
ones, are spread over tasks. An empty table gives an empty result. Other columns are
not read. Without a list, only the rules judge; an entry without a path fits all paths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import bloom
from sparkloom.llm.common import staged, table, with_group

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The rules (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: The default list of the method: hosts made of these words, and some sections of any host below these domains.
SUBJECTS = ("adult", "adult-x", "betting", "casino", "cheap-pills", "crack", "escort", "lottery", "malware", "phishing", "porn", "replica", "spam", "spam-farm", "torrent", "warez")
DOMAINS = ("example.com", "example.net", "example.org")
SECTIONS = ("/ads/", "/casino/", "/doorway/", "/popunder/")
BROADCAST = 200_000


def default_list() -> list[tuple[str, str, str]]:
    return [(f"{w}.{d}", "/", "block") for d in DOMAINS for w in SUBJECTS] + [(d, p, "block") for d in DOMAINS for p in SECTIONS]


def rest(url: str) -> str:
    return f"CASE WHEN instr({url}, '://') > 0 THEN substring({url}, instr({url}, '://') + 3) ELSE '' END"


def parts(url: str) -> tuple[str, str]:
    """SQL expressions of the host and the path of a URL (an SQL expression), as they stand."""
    host = f"translate(regexp_extract({rest(url)}, '^[^/?#]*', 0), '{UPPER}', '{LOWER}')"
    return host, f"regexp_extract({rest(url)}, '^[^/?#]*([^?#]*)', 1)"


def canonical(host: str, path: str) -> tuple[str, str]:
    """SQL expressions of host and path in canonical form, from those as they stand; an empty host has no path."""
    own = f"regexp_replace(regexp_replace(regexp_replace({host}, '^.*@', ''), ':[0-9]*$', ''), '[.]$', '')"
    return own, f"CASE WHEN {own} = '' THEN '' ELSE regexp_replace(concat('/', {path}), '/+', '/') END"


def listed(spark: SparkSession, rules=RULES, entries: DataFrame | None = None) -> DataFrame:
    """Rules and list as one table: l_host, l_path, l_verdict, l_rule. entries: host, path, verdict, in any form."""
    fixed = spark.createDataFrame([(h, p, v, True) for h, p, v in rules], "l_host string, l_path string, l_verdict string, l_rule boolean")
    if entries is None:
        entries = spark.createDataFrame(default_list(), "host string, path string, verdict string")
    host, path = canonical("lower(host)", "coalesce(path, '')")
    more = entries.where("host IS NOT NULL AND verdict IN ('allow', 'block')").select(F.expr(host).alias("l_host"), F.expr(path).alias("l_path"), F.col("verdict").alias("l_verdict"), F.lit(False).alias("l_rule"))
    return fixed.unionByName(more.where("l_host != ''"))


def judge(pages: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", broadcast: int = BROADCAST) -> DataFrame:
    """One row per page: id, host, path, rule, verdict (allow where nothing fits). entries: see listed()."""
    keyed = entries.select(F.concat(F.when(F.col("l_rule"), "r ").otherwise("l "), "l_host", "l_path").alias("__key"), "l_verdict", "l_rule")
    keyed = staged(keyed.groupBy("__key", "l_rule").agg(F.max("l_verdict").alias("l_verdict")), "listed")
    #: Lengths in the list: bounded by the number of labels of a host and by the longest listed path.
    shape = entries.agg(*(F.collect_set(F.when(F.col("l_rule") == rule, x)) for rule in (True, False) for x in (F.size(F.split("l_host", "[.]")), F.length("l_path"))), F.count("*")).first()
    n = shape[4]
    urls = pages.select(F.col(url_col).cast("string").alias("__url")).where(F.col("__url").isNotNull()).distinct()
    host, path = parts("__url")
    own_host, own_path = canonical("__host", "__path")
    urls = urls.select("__url", F.expr(host).alias("__host"), F.expr(path).alias("__path")).select("*", F.expr(own_host).alias("__own_host"), F.expr(own_path).alias("__own_path"))
    numbers = lambda found: f"CAST(array({', '.join(map(str, sorted(found)))}) AS array<int>)"

    def proposed(mark: str, host: str, path: str, labels, lengths) -> str:
        """Keys of all listed shapes that a URL has: two nested lambdas, whatever the number of shapes."""
        suffixes = f"transform(filter({numbers(labels)}, a -> a <= size(split({host}, '[.]'))), a -> substring_index({host}, '.', -a))"
        return f"flatten(transform({suffixes}, s -> transform(filter({numbers(lengths)}, b -> b <= length({path})), b -> concat('{mark} ', s, substring({path}, 1, b)))))"

    keys = f"concat({proposed('r', '__host', '__path', shape[0], shape[1])}, {proposed('l', '__own_host', '__own_path', shape[2], shape[3])})"
    proposals = urls.select("__url", F.explode(F.expr(keys)).alias("__key"))
    blocks = bloom.blocks_for(n)
    hits = bloom.passing(proposals, F.xxhash64("__key"), bloom.build(keyed.select(F.xxhash64("__key").alias("__k")), blocks), blocks)
    if n <= broadcast:
        hits = hits.join(F.broadcast(keyed), "__key")
    else:
        sizes = keyed.join(hits.groupBy("__key").agg(F.count("*").alias("__c")), "__key")
        hits = with_group(hits, staged(sizes, "listed-sizes"), ["__key"], "__c").where("__c IS NOT NULL")
    best = hits.groupBy("__url").agg(F.max(F.struct("l_rule", F.length("__key").alias("l_length"), "__key", "l_verdict")).alias("__best"))
    times = pages.groupBy(F.col(url_col).cast("string").alias("__url")).agg(F.count("*").alias("__c"))
    judged = staged(best.join(times, "__url").select("__url", "__c", F.when(F.col("__best.l_rule"), F.substring("__best.__key", 3, 1 << 20)).alias("rule"), F.col("__best.l_verdict").alias("verdict")), "judged")
    host, path = parts("__url")
    rows = pages.select(F.col(id_col), F.col(url_col).cast("string").alias("__url"))
    return with_group(rows, judged, ["__url"], "__c").select(
        id_col,
        F.coalesce(F.expr(host), F.lit("")).alias("host"),
        F.coalesce(F.expr(path), F.lit("")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
    )


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), listed(spark))


def _values(rows) -> str:
    return ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rows)


ORACLE = {
    "op9_url_filter": rf"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
c AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '[.]$', '') AS own_host FROM p),
d AS (SELECT *, CASE WHEN own_host = '' THEN '' ELSE regexp_replace('/' || path, '/+', '/', 'g') END AS own_path FROM c),
r(h, p, v) AS (VALUES {_values(RULES)}),
l(h, p, v) AS (VALUES {_values(default_list())})
SELECT d.page_id, d.host, d.path,
       (SELECT r.h || r.p FROM r WHERE (d.host = r.h OR ends_with(d.host, '.' || r.h)) AND starts_with(d.path, r.p) ORDER BY length(r.h || r.p) DESC LIMIT 1) AS rule,
       coalesce((SELECT r.v FROM r WHERE (d.host = r.h OR ends_with(d.host, '.' || r.h)) AND starts_with(d.path, r.p) ORDER BY length(r.h || r.p) DESC LIMIT 1),
                (SELECT l.v FROM l WHERE (d.own_host = l.h OR ends_with(d.own_host, '.' || l.h)) AND starts_with(d.own_path, l.p) ORDER BY length(l.h || l.p) DESC LIMIT 1), 'allow') AS verdict
FROM d
"""
}
