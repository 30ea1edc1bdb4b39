"""Ladders and maps that classify files, layers, frameworks and errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkloom.functions.paths import glob_regex

#: File types and languages by extension.
FILE_TYPES = {
    ".java": "source",
    ".jsp": "web", ".jspx": "web", ".html": "web", ".htm": "web",
    ".js": "script", ".css": "style",
    ".xml": "config", ".properties": "config", ".yml": "config", ".yaml": "config",
    ".sql": "database",
    ".tld": "descriptor",
}
EXTENSION_LANGUAGES = {
    ".java": "java",
    ".jsp": "jsp", ".jspx": "jsp",
    ".js": "javascript",
    ".html": "html", ".htm": "html",
    ".css": "css",
    ".xml": "xml",
    ".properties": "properties",
    ".yml": "yaml", ".yaml": "yaml",
    ".sql": "sql",
    ".tld": "tld",
    ".vbs": "vbscript",
}
#: Layers and the subdomain types that they stand for.
LAYER_TYPES = {"UI": "screen", "Service": "service", "Database": "service", "Integration": "integration", "Reporting": "reporting", "Configuration": "utility", "Utility": "utility", "Other": "utility"}
LAYERS = ("UI", "Service", "Database", "Integration", "Utility", "Configuration", "Reporting", "Other", "none")
ARCHITECTURE = ("application", "business", "data_access", "security", "shared", "unknown")
#: Words of an error text and the class they point to; the first counts.
ERRORS = (("timeout", "timeout"), ("timed out", "timeout"), ("permission", "permission"), ("access denied", "permission"), ("not found", "missing"), ("no such file", "missing"), ("memory", "memory"), ("decode", "encoding"), ("encoding", "encoding"), ("syntax", "parse"), ("parse", "parse"), ("connection", "network"))
#: Framework hints and what points to them.
FRAMEWORKS = (("spring", r"(?i)\bspring|@Controller|@Service\b|@Repository"), ("struts", r"(?i)struts|ActionForm|<html:"), ("jsf", r"(?i)\bjsf\b|faces-config|<h:"), ("jstl", r"<c:|<fmt:|<fn:"), ("hibernate", r"(?i)hibernate|@Entity"), ("jaxrs", r"@Path\b|@GET\b|@POST\b|javax\.ws\.rs"), ("tiles", r"(?i)tiles"))


def mapped(value: Column, table: dict[str, str], default: str | None = None) -> Column:
    pairs = [x for k, v in table.items() for x in (F.lit(k), F.lit(v))]
    found = F.try_element_at(F.create_map(*pairs), value)
    return found if default is None else F.coalesce(found, F.lit(default))


def file_type(ext: Column) -> Column:
    return mapped(ext, FILE_TYPES, "other")


def language_of(ext: Column) -> Column:
    return mapped(ext, EXTENSION_LANGUAGES, "other")


def subdomain_type(layer: Column) -> Column:
    return mapped(layer, LAYER_TYPES, "utility")


def cast_to(value: Column, domain: tuple[str, ...], default: str) -> Column:
    """Case-insensitive cast to a fixed domain."""
    return F.coalesce(*(F.when(F.lower(value) == d.lower(), F.lit(d)) for d in domain), F.lit(default))


def to_layer(value: Column) -> Column:
    return cast_to(value, LAYERS, "Other")


def to_architecture(value: Column) -> Column:
    return cast_to(F.regexp_replace(value, "(?i)^dataaccess$", "data_access"), ARCHITECTURE, "unknown")


def first_match(text: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """rules: (name, glob); the first that matches."""
    return F.coalesce(*(F.when(text.rlike(glob_regex(g)), F.lit(n)) for n, g in rules), F.lit(default))


def last_match(text: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    return first_match(text, list(reversed(rules)), default)


def indicator_match(text: Column, rules: list[tuple[str, list[str]]], default: str | None = None) -> Column:
    """rules: (name, words); the first name with a word that the text contains."""
    out = []
    for name, words in rules:
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(text, F.lit(w))
        out.append(F.when(hit, F.lit(name)))
    return F.coalesce(*out, F.lit(default))


def error_class(message: Column) -> Column:
    return F.coalesce(*(F.when(F.contains(F.lower(message), F.lit(w)), F.lit(c)) for w, c in ERRORS), F.lit("unknown"))


def framework_hints(text: Column, rules=FRAMEWORKS) -> Column:
    return F.array_sort(F.array_compact(F.array(*(F.when(text.rlike(p), F.lit(n)) for n, p in rules))))


def is_test(path: Column) -> Column:
    return path.rlike(r"(?i)(?:^|/)tests?/|(?:Test|Tests|IT|Spec)[.][a-z]+$")


def is_config(kind: Column, language: Column, path: Column) -> Column:
    return (kind == "config") | (language == "properties") | ((language == "xml") & path.rlike(r"(?i)(?:web|struts|tiles|validation|applicationContext|pom|config)[^/]*[.]xml$"))


def is_build_file(name: Column) -> Column:
    return F.lower(name).isin("pom.xml", "build.gradle", "build.gradle.kts", "settings.gradle", "makefile", "package.json") | F.lower(name).rlike(r"build.*[.]xml$")


def component_type(kind: Column, value: Column) -> Column:
    """The type given, else by the value: url, page, html, path, string."""
    return F.coalesce(F.nullif(F.trim(kind), F.lit("")), F.when(value.rlike("^https?://"), "url").when(value.rlike("[.]jspf?$"), "page").when(value.rlike("[.]html?$"), "html").when(F.contains(value, F.lit("/")), "path").otherwise("string"))


#: Kinds of components.
DATABASE_KINDS = ("table", "view", "procedure", "function", "trigger", "database")
WEB_KINDS = ("page", "servlet", "filter", "controller", "endpoint")


def is_database_related(kind: Column, table: Column) -> Column:
    return kind.isin(*DATABASE_KINDS) | table.isNotNull()


def is_web_component(kind: Column, urls: Column) -> Column:
    return kind.isin(*WEB_KINDS) | (F.size(urls) > 0)
