"""Layers by rules from a table, and code edges filtered by packages: multi-pattern joins of constant plan size.

A rule is (ord, layer, pattern). Patterns are globs: `**` is anything, `*` anything but the
separator; they fit anywhere, letters of any case. Every rule is indexed by one trigram of
its longest literal part, values by all of theirs, so a value meets only rules that can fit
it; what meets is tested in full, and the least ord wins. Rules without three literal
letters in a row meet every value (they are few: `*` and the like). Values are made
distinct first, so a package of a million files is matched once.

Defined results: a null or empty value, or one that no rule fits, has the layer `Other`.
Of rules with one ord the least layer name wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters of an index key.
GRAM = 3
NONE = "Other"


def glob_pattern(glob: Column, separator: str) -> Column:
    """The regular expression of a glob; a dot in it stands for any sign, as the rules mean it."""
    return F.concat(F.lit("(?is)"), F.replace(F.replace(F.replace(glob, F.lit("**"), F.lit("\x00")), F.lit("*"), F.lit(f"[^{separator}]*")), F.lit("\x00"), F.lit(".*")))


def grams(text: Column) -> Column:
    """The distinct runs of GRAM letters of a text in lower case."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - (GRAM - 1), F.lit(0)), F.lit(1)), lambda k: F.lower(F.substr(text, k, F.lit(GRAM)))))


def indexed(rules: DataFrame, separator: str) -> DataFrame:
    """ord, layer, pattern, regex, gram ('' where there is none)."""
    literals = F.filter(F.regexp_extract_all("pattern", F.lit(r"([A-Za-z0-9_/-]+)"), F.lit(1)), lambda x: F.length(x) >= GRAM)
    longest = F.array_max(F.transform(literals, lambda x: F.struct(F.length(x).alias("n"), F.lower(x).alias("x"))))["x"]
    return rules.select("ord", "layer", "pattern", glob_pattern(F.col("pattern"), separator).alias("regex"), F.coalesce(F.substring(longest, 1, GRAM), F.lit("")).alias("gram"))


def matched(values: DataFrame, value: str, rules: DataFrame, separator: str = ".") -> DataFrame:
    """Each distinct value with its first rule: value, layer, pattern (null where none fits)."""
    own = values.select(F.col(value).alias("value")).distinct()
    has = F.length("value") >= GRAM
    keyed = own.where("value IS NOT NULL AND value != ''").select("value", F.explode(F.concat(F.array(F.lit("")), F.when(has, grams(F.col("value"))).otherwise(F.array().cast("array<string>")))).alias("gram"))
    met = keyed.join(indexed(rules, separator), "gram").where(F.regexp_like("value", F.col("regex")))
    first = met.groupBy(F.col("value").alias("__v")).agg(F.min(F.struct("ord", "layer", "pattern")).alias("r"))
    return own.join(first, F.col("value").eqNullSafe(F.col("__v")), "left").select("value", F.coalesce("r.layer", F.lit(NONE)).alias("layer"), F.col("r.pattern").alias("pattern"))


def signs(rules: DataFrame) -> DataFrame:
    """The rules of one row, in order: an array column for tests within a row. A table of rules is a configuration."""
    return rules.agg(F.array_sort(F.collect_list(F.struct("ord", "layer", "sign"))).alias("__signs"))


def code_layer(text: Column, annotations: Column, names: Column, listed: Column) -> Column:
    """The layer of the first sign that the text holds, an annotation is, or, as *x*, a type's name holds in any case.
    text: the signs that the text holds."""
    bare = lambda s: F.lower(F.regexp_replace(s, r"^\*|\*$", ""))
    wild = lambda s: F.startswith(s, F.lit("*")) & F.endswith(s, F.lit("*"))
    fits = lambda s: F.array_contains(text, s) | F.array_contains(annotations, s) | (wild(s) & F.exists(names, lambda n: F.contains(F.lower(n), bare(s))))
    return F.get(F.filter(listed, lambda r: F.coalesce(fits(r["sign"]), F.lit(False))), F.lit(0))["layer"]


def detected(files: DataFrame, declarations: DataFrame, packages: DataFrame, indicators: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """path, package, layer, by: the package's first rule, else the first indicator (ord, layer, sign) that the text,
    its annotations or type names show, else the layer that the mapping gives an annotation.
    files: path, text. declarations: as structure.declarations gives."""
    facts = declarations.groupBy("path").agg(
        F.min("package").alias("package"),
        F.array_distinct(F.flatten(F.array_sort(F.collect_list("annotations")))).alias("annotations"),
        F.array_sort(F.collect_set(F.when(F.col("kind").isin("class", "interface", "enum", "record", "annotation"), F.col("name")))).alias("names"),
    )
    by_package = matched(facts, "package", packages).select(F.col("value").alias("package"), F.col("layer").alias("p"))
    #: What a text shows is told beside it; no text is joined. The files' size is guessed too small to broadcast them.
    shown = files.crossJoin(F.broadcast(signs(indicators))).select("path", "__signs", F.transform(F.filter("__signs", lambda r: F.contains(F.col("text"), r["sign"])), lambda r: r["sign"]).alias("__shown"))
    rows = shown.hint("merge").join(facts, "path").join(by_package, "package", "left")
    marks = F.transform("annotations", lambda a: F.concat(F.lit("@"), a))
    given = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair)) if mapping else F.lit(None).cast("map<string,string>")
    mapped = F.get(F.filter(F.transform(marks, lambda a: F.try_element_at(given, a)), lambda x: x.isNotNull()), F.lit(0))
    p, c = F.nullif("p", F.lit(NONE)), code_layer(F.col("__shown"), marks, F.col("names"), F.col("__signs"))
    found = rows.select("path", "package", p.alias("p"), c.alias("c"), mapped.alias("m"))
    by = F.when(F.col("p").isNotNull(), "package").when(F.col("c").isNotNull(), "code").when(F.col("m").isNotNull(), "framework").otherwise("none")
    return found.select("path", "package", F.coalesce("p", "c", "m", F.lit(NONE)).alias("layer"), by.alias("by"))


def target_package(reference: Column) -> Column:
    """The package of `a.b.Class.method` or `a.b.Class.x`: what stands before the last part that begins with a capital,
    the last part of all left out; without one, all but the last two parts."""
    capital = F.regexp_extract(reference, r"(?s)^(?:(.*)\.)?[A-Z][^.]*\.", 1)
    return F.coalesce(F.when(reference.rlike(r"(?:^|\.)[A-Z][^.]*\."), capital).otherwise(F.regexp_extract(reference, r"(?s)^(.*)\.[^.]*\.[^.]*\z", 1)), F.lit(""))


def filtered(edges: DataFrame, packages: DataFrame | None = None, exclude_same: bool = False, current: str = "package", reference: str = "to_reference") -> DataFrame:
    """The edges to a package that begins with one of the listed (packages: prefix), and, if asked, not to their own.

    The target's prefixes of the lengths that occur in the list meet it in one equi-join; the longest is kept
    as `prefix`. Targets without a package fit no list."""
    rows = edges.withColumn("__target", target_package(F.col(reference)))
    if packages is not None:
        listed = packages.select(F.col("prefix")).where("prefix IS NOT NULL").distinct()
        lengths = listed.agg(F.array_sort(F.collect_set(F.length("prefix"))).alias("__lengths"))
        targets = rows.select("__target").distinct().where("__target != ''").crossJoin(F.broadcast(lengths))
        begun = targets.select("__target", F.explode(F.filter("__lengths", lambda n: n <= F.length("__target"))).alias("n")).withColumn("prefix", F.expr("substring(__target, 1, n)"))
        longest = begun.join(listed, "prefix").groupBy("__target").agg(F.max_by("prefix", "n").alias("prefix"))
        rows = rows.join(longest, "__target")
    if exclude_same:
        rows = rows.where(F.col(current).isNull() | (F.col(current) == "") | (F.col("__target") != F.col(current)))
    return rows.drop("__target")
