"""Chunks to embed: one a class, method and page, one line for a configuration file, the whole text of other files.

A chunk's text says what the code declares, in words; its metadata (a map) says where it
stands, from its own row and from the file's columns. Members come from the intervals of
operators.structure, not from lengths.

Defined results: a file without types has no class chunks; a null text counts as empty; a
page without forms is `jsp page` and its elements. Files of kinds without structure are
one chunk of their whole text, an empty one too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.extract import all_of, scriptlets
from sparkloom.operators import structure

#: Methods and fields that a class chunk names (a fixed value of the format).
LISTED = 5
SQL = r"(?i)\"\s*(?:SELECT|INSERT|UPDATE|DELETE)\s"
PROCEDURE = r"\{\s*(?:\?\s*=\s*)?call\s+([\w.]+)"
#: Tags of pages that are no elements of their own.
FIELDS = ("input", "select", "textarea", "button", "form")


def visibility(modifiers: Column) -> Column:
    return F.coalesce(*(F.when(F.array_contains(modifiers, v), F.lit(v)) for v in ("public", "protected", "private")), F.lit("package"))


def words(*parts: Column) -> Column:
    """The parts that are not null, one blank between."""
    return F.concat_ws(" ", *parts)


def each(list_: Column, word: str) -> Column:
    """The word before each of a list, or null for none."""
    return F.nullif(F.array_join(F.transform(list_, lambda x: F.concat(F.lit(f"{word} "), x)), " "), F.lit(""))


def metadata(**values: Column) -> Column:
    """A map of what is not null."""
    pairs = F.array(*(F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in values.items()))
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))


def kept(files: DataFrame) -> tuple[str, ...]:
    """The metadata of the file, which chunks carry where there is any."""
    return ("__context",) if "__context" in files.columns else ()


def class_and_method_chunks(files: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """chunk_id, chunk_type, source_path, start_line, end_line, content, own (metadata)."""
    keep = kept(files)
    d = structure.members(files, path_col, text_col, keep)
    member = F.struct("begin", F.concat_ws(" ", F.col("kind"), visibility(F.col("modifiers")), F.col("value_type"), F.col("name")).alias("line"))
    is_type, is_member = F.col("kind").isin("class", "enum", "record", "interface", "annotation"), F.col("kind").isin("method", "field")
    #: A type and its members meet under the type's number, in one group; no table is joined.
    told = F.struct("name", "type_name", "package", "annotations", "extends", "implements", "start_line", "end_line")
    rows = d.where(is_type | is_member).select("path", *keep, F.when(is_type, F.col("number")).otherwise(F.col("owner")).alias("number"), "kind", F.when(is_type, told).alias("t"), member.alias("m"))
    held = rows.groupBy("path", "number").agg(
        F.first("t", ignorenulls=True).alias("t"),
        *(F.first(k).alias(k) for k in keep),
        *(F.transform(F.slice(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("m")))), 1, LISTED), lambda m: m["line"]).alias(f"{k}s") for k in ("method", "field")),
        *(F.count_if(F.col("kind") == k).alias(f"n_{k}s") for k in ("method", "field")),
    )
    types = held.where("t IS NOT NULL").select("path", *keep, "t.*", "methods", "fields", "n_methods", "n_fields")
    lists = lambda c: F.nullif(F.array_join(c, " "), F.lit(""))
    text = words(
        F.concat(F.lit("class "), "name"),
        F.concat(F.lit("package "), "package"),
        each(F.col("annotations"), "annotation"),
        F.concat(F.lit("extends "), "extends"),
        each(F.col("implements"), "implements"),
        lists(F.col("methods")),
        lists(F.col("fields")),
    )
    count = lambda c: F.coalesce(c, F.lit(0))
    own = metadata(class_name=F.col("type_name"), package=F.col("package"), methods_count=count(F.col("n_methods")), fields_count=count(F.col("n_fields")), annotations=lists(F.col("annotations")))
    classes = types.select(F.concat(F.lit("class_"), "type_name", F.lit("_"), "start_line", F.lit("_"), F.md5("path")).alias("chunk_id"), F.lit("class").alias("chunk_type"), F.col("path").alias("source_path"), "start_line", "end_line", text.alias("content"), own.alias("own"), *keep)
    methods = d.where("kind = 'method'")
    body = F.when(F.col("has_body"), F.concat(F.lit("{"), "inside"))
    seen = visibility(F.col("modifiers"))
    text = words(
        F.concat(F.lit("method "), "name", F.lit(" in class "), F.regexp_extract("type_name", r"([^.]*)$", 1)),
        F.concat(F.lit("visibility "), seen),
        F.concat(F.lit("returns "), "value_type"),
        F.nullif(F.array_join(F.transform("parameters", lambda p: F.concat_ws(" ", F.lit("parameter"), p["type"], p["name"])), " "), F.lit("")),
        each(F.col("annotations"), "annotation"),
        each(F.col("modifiers"), "modifier"),
    )
    own = metadata(
        method_name=F.col("name"),
        class_name=F.col("type_name"),
        visibility=seen,
        return_type=F.col("value_type"),
        parameters_count=F.size("parameters"),
        annotations=lists(F.col("annotations")),
        complexity_score=F.col("complexity"),
        has_sql=F.coalesce(body.rlike(SQL), F.lit(False)),
        stored_procedure_names=lists(F.coalesce(F.array_distinct(all_of(body, PROCEDURE)), F.array())),
    )
    of_methods = methods.select(F.concat(F.lit("method_"), "type_name", F.lit("_"), "name", F.lit("_"), "begin", F.lit("_"), F.md5("path")).alias("chunk_id"), F.lit("method").alias("chunk_type"), F.col("path").alias("source_path"), "start_line", "end_line", text.alias("content"), own.alias("own"), *keep)
    return classes.unionByName(of_methods)


def page_chunks(pages: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """One chunk a page: its forms with their fields and buttons, other elements with names of their own, and whether it holds code."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    attribute = lambda tag, name: F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*[\"']([^\"']*)[\"']", 1)
    forms = F.regexp_extract_all(t, F.lit(r"(?is)<(?:\w+:)?form\b[^>]*>.*?(?=</(?:\w+:)?form\s*>|<(?:\w+:)?form\b|\z)"), F.lit(0))
    fields = lambda f: F.transform(F.regexp_extract_all(f, F.lit(r"(?is)<(?:\w+:)?(?:input|select|textarea)\b[^>]*>"), F.lit(0)), lambda x: F.concat_ws(" ", F.lit("field"), F.nullif(F.coalesce(F.nullif(attribute(x, "type"), F.lit("")), F.lower(F.regexp_extract(x, r"(?i)(input|select|textarea)", 1))), F.lit("")), F.nullif(attribute(x, "name"), F.lit(""))))
    buttons = lambda f: F.transform(F.regexp_extract_all(f, F.lit(r"(?is)<button\b[^>]*>"), F.lit(0)), lambda x: F.concat_ws(" ", F.lit("button"), F.nullif(attribute(x, "type"), F.lit("")), F.nullif(attribute(x, "name"), F.lit(""))))
    form = lambda f: F.concat_ws(" ", F.lit("form"), F.nullif(attribute(F.regexp_extract(f, r"(?is)^(<[^>]*>)", 1), "name"), F.lit("")), F.nullif(F.array_join(fields(f), " "), F.lit("")), F.nullif(F.array_join(buttons(f), " "), F.lit("")))
    elements = F.array_sort(F.array_distinct(F.filter(F.transform(F.regexp_extract_all(t, F.lit(r"<(\w+(?::\w+)?)[\s/>]"), F.lit(1)), lambda x: F.lower(x)), lambda x: ~x.isin(*FIELDS))))
    code = F.size(scriptlets(t)) > 0
    text = words(F.lit("jsp page"), F.nullif(F.array_join(F.transform(forms, form), " "), F.lit("")), each(elements, "element"), F.when(code, F.lit("embedded java blocks")))
    own = metadata(forms_count=F.size(forms), elements_count=F.size(elements), has_embedded_java=code)
    lines = F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1
    return pages.select(F.concat(F.lit("jsp_"), F.md5(F.col(path_col))).alias("chunk_id"), F.lit("jsp").alias("chunk_type"), F.col(path_col).alias("source_path"), F.lit(1).alias("start_line"), lines.alias("end_line"), text.alias("content"), own.alias("own"), *kept(pages))


def whole_chunks(files: DataFrame, kind: str, content: Column, path_col: str = "path") -> DataFrame:
    """One chunk a file."""
    lines = F.length(content) - F.length(F.replace(content, F.lit("\n"), F.lit(""))) + 1
    return files.select(F.concat(F.lit(f"{kind}_"), F.md5(F.col(path_col))).alias("chunk_id"), F.lit(kind).alias("chunk_type"), F.col(path_col).alias("source_path"), F.lit(1).alias("start_line"), lines.alias("end_line"), content.alias("content"), F.map_from_arrays(F.array(F.lit("file_type")), F.array(F.lit("configuration" if kind == "config" else kind))).alias("own"), *kept(files))


def chunks(files: DataFrame, context: list[str], path_col: str = "path", text_col: str = "text") -> DataFrame:
    """The chunks of all files with metadata: the chunk's own entries and the file's columns named in context (which win).
    files: path, language, type, text and the context columns."""
    java, page, config = F.col("language") == "java", F.col("type") == "web", F.col("type") == "config"
    rest = ~F.coalesce(java, F.lit(False)) & ~F.coalesce(page, F.lit(False)) & ~F.coalesce(config, F.lit(False))
    around = metadata(**{f"file_{c}" if c in ("path", "language", "type", "hash") else c: F.col(c) for c in context})
    files = files.where(F.col(path_col).isNotNull()).withColumn("__context", around)
    made = class_and_method_chunks(files.where(java), path_col, text_col)
    made = made.unionByName(page_chunks(files.where(page & ~java), path_col, text_col))
    made = made.unionByName(whole_chunks(files.where(config & ~java & ~page), "config", F.concat(F.lit("Configuration file: "), F.col(path_col)), path_col))
    made = made.unionByName(whole_chunks(files.where(rest), "file", F.coalesce(F.col(text_col), F.lit("")), path_col))
    return made.select("chunk_id", "chunk_type", "source_path", "start_line", "end_line", "content", F.map_concat("__context", F.map_filter("own", lambda k, _: ~F.array_contains(F.map_keys("__context"), k))).alias("metadata"))
