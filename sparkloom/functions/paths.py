"""Path, name and identity functions: columns in, columns out."""

from __future__ import annotations

import posixpath
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize_path(path: Column) -> Column:
    """Slashes only, none doubled, no dot segments that stand alone, no slash at the end."""
    p = F.regexp_replace(path, r"\\", "/")
    p = F.regexp_replace(F.regexp_replace(p, "/+", "/"), "^(?:[.]/)+", "")
    return F.when(p.isin("", "/"), p).otherwise(F.regexp_replace(p, "/$", ""))


def to_relative_path(path: Column, base: Column) -> Column:
    p, b = normalize_path(path), normalize_path(base)
    return F.when(p == b, F.lit(".")).when(F.startswith(p, F.concat(b, F.lit("/"))), F.substr(p, F.length(b) + 2)).otherwise(p)


def parent_path(path: Column) -> Column:
    p = normalize_path(path)
    return F.when(F.contains(p, F.lit("/")), F.regexp_replace(p, "/[^/]*$", "")).otherwise(F.lit("."))


def filename(path: Column) -> Column:
    return F.element_at(F.split(normalize_path(path), "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(filename(path), r"(.)[.][^.]*$", "$1")


def extension(path: Column) -> Column:
    """With its dot, in lower case; empty where there is none."""
    return F.lower(F.regexp_extract(filename(path), r".([.][^.]*)$", 1))


def join_paths(*parts: Column) -> Column:
    return normalize_path(F.concat_ws("/", *parts))


def is_absolute(path: Column) -> Column:
    return path.rlike(r"^(?:/|[A-Za-z]:[\\/])")


def canonical_path(path: Column, roots: tuple[str, ...] = ()) -> Column:
    """Drive and first matching root stripped, slashes collapsed, one at the start; empty to null."""
    p = F.regexp_replace(F.regexp_replace(F.regexp_replace(path, r"\\", "/"), "^[A-Za-z]:", ""), "/+", "/")
    for root in reversed(roots):
        at = "/" + root.strip("/") + "/"
        p = F.when(F.contains(p, F.lit(at)), F.substr(p, F.instr(p, at) + len(at) - 1)).otherwise(p)
    return F.nullif(F.regexp_replace(p, "^/?(.+)$", "/$1"), F.lit(""))


def glob_regex(pattern: str) -> str:
    """`**` crosses anything, `*` stops at dots beside `**`; without `**` a plain shell pattern."""
    if "**" not in pattern:
        out = "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in pattern)
        return f"(?s)^{out}$"
    held = pattern.replace("**", "\0").replace("*", "[^.]*").replace("\0", ".*")
    return f"^{held}$"


def matches_glob(text: Column, pattern: str) -> Column:
    return text.rlike(glob_regex(pattern))


def expand_braces(pattern: str) -> list[str]:
    """One level of {a,b}."""
    m = re.search(r"\{([^{}]*)\}", pattern)
    return [pattern[: m.start()] + x + pattern[m.end() :] for x in m[1].split(",")] if m else [pattern]


def excluded(path: Column, patterns: list[str]) -> Column:
    """Globs are stripped to substrings, as exclusions are."""
    hit = F.lit(False)
    for p in patterns:
        if bare := p.replace("*", "").strip("/"):
            hit = hit | F.contains(path, F.lit(bare))
    return hit


def component_after(parts: Column, pattern: str) -> Column:
    """The segment after the first segment of the pattern that the path has, else the last."""
    out = F.element_at(parts, -1)
    for s in reversed([s for s in re.split(r"[./]", pattern) if s and "*" not in s]):
        at = F.array_position(parts, s)
        out = F.when((at > 0) & (at < F.size(parts)), F.get(parts, at.cast("int"))).otherwise(out)
    return out


def literal_segment(pattern: str) -> str | None:
    return next((s for s in re.split(r"[./]", pattern) if s and not re.search(r"[*?\[]", s)), None)


def package_name(path: Column) -> Column:
    return F.replace(F.regexp_replace(normalize_path(path), "/?[^/]*$", ""), F.lit("/"), F.lit("."))


def last_meaningful(parts: Column, generic: list[str]) -> Column:
    return F.try_element_at(F.filter(parts, lambda p: ~F.lower(p).isin(generic)), F.lit(-1))


def normalize_namespace(ns: Column) -> Column:
    return F.nullif(F.regexp_replace(F.trim(ns), r"^[/*]+|[/*]+$", ""), F.lit(""))


def normalize_action(action: Column) -> Column:
    return F.regexp_replace(action, r"^[/*]+", "")


def clean_method(method: Column) -> Column:
    return F.when(~method.rlike(r"[{}]"), F.nullif(F.trim(method), F.lit("")))


def route_id(namespace: Column, action: Column) -> Column:
    """route_{ns}_{action}; slashes to underscores, stars to STAR."""
    ns = normalize_namespace(namespace)
    name = F.when(ns.isNotNull(), F.concat_ws("_", ns, action)).otherwise(action)
    return F.concat(F.lit("route_"), F.replace(F.replace(name, F.lit("/"), F.lit("_")), F.lit("*"), F.lit("STAR")))


def rest_route_id(path: Column, verb: Column) -> Column:
    return F.concat(F.lit("route_"), F.regexp_replace(path, "[^A-Za-z0-9]+", "_"), F.lit("_"), F.upper(verb))


def compose_path(*parts: Column) -> Column:
    return F.regexp_replace(F.concat(F.lit("/"), F.concat_ws("/", *parts)), "/+", "/")


def slug(text: Column) -> Column:
    return F.regexp_replace(text, "[^A-Za-z0-9_:.-]+", "_")


def page_id(path: Column) -> Column:
    return F.concat(F.lit("jsp_"), stem(path))


def object_token(name: Column) -> Column:
    """Brackets, arguments and schema stripped, lower case."""
    bare = F.regexp_replace(F.regexp_replace(name, r"\(.*$", ""), r"[\[\]\"`]", "")
    return F.lower(F.trim(F.element_at(F.split(bare, "[.]"), -1)))


def split_fqn(fqn: Column) -> tuple[Column, Column]:
    return F.nullif(F.regexp_extract(fqn, r"^(.*)[.][^.]*$", 1), F.lit("")), F.element_at(F.split(fqn, "[.]"), -1)


def clean_target(raw: Column) -> Column:
    return F.regexp_replace(F.trim(raw), "[?#].*$", "")


def resolved_target(including: Column, raw: Column) -> Column:
    """A relative target against the file that names it; dot segments are folded in Arrow batches."""

    @F.pandas_udf(T.StringType())
    def fold(paths: pd.Series) -> pd.Series:
        return paths.map(lambda p: None if p is None else posixpath.normpath(p).lstrip("/"))

    target = clean_target(raw)
    return fold(F.when(F.startswith(target, F.lit("/")), target).otherwise(F.concat_ws("/", parent_path(including), target)))


def logical_database(path: Column) -> Column:
    parts = F.split(normalize_path(path), "/")
    at = F.array_position(F.transform(parts, F.lower), "db")
    return F.when(at > 0, F.get(parts, at.cast("int")))


def component_id(path: Column, name: Column, kind: Column) -> Column:
    return F.substring(F.md5(F.concat_ws(":", path, name, kind)), 1, 12)


def qualified_name(namespace: Column, package: Column, name: Column) -> Column:
    return F.concat_ws(".", F.coalesce(namespace, package), name)


#: URL words and their business domains; the first that a segment contains counts.
DOMAIN_WORDS = (
    ("employee", "employee_management"),
    ("staff", "employee_management"),
    ("person", "employee_management"),
    ("schedule", "scheduling"),
    ("shift", "scheduling"),
    ("calendar", "scheduling"),
    ("time", "timekeeping"),
    ("timesheet", "timekeeping"),
    ("payroll", "payroll"),
    ("pay", "payroll"),
    ("benefit", "benefits"),
    ("contract", "contracts"),
    ("labor", "labor_relations"),
    ("skill", "skills_qualifications"),
    ("approve", "approvals_workflow"),
    ("approval", "approvals_workflow"),
    ("position", "position_job_management"),
    ("job", "position_job_management"),
    ("holiday", "holidays_calendars"),
    ("overtime", "overtime_pay_rules"),
    ("report", "reporting_analytics"),
    ("admin", "administration"),
    ("config", "administration"),
    ("setup", "administration"),
    ("security", "security_access"),
    ("auth", "security_access"),
    ("integration", "integrations_interfaces"),
    ("interface", "integrations_interfaces"),
    ("api", "integrations_interfaces"),
)


def business_domain(path: Column, words=DOMAIN_WORDS) -> Column:
    """By the first segment, then the second; else the first itself if long enough."""
    parts = F.filter(F.split(F.lower(path), "/"), lambda s: s != "")
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    by = lambda s: F.coalesce(*(F.when(F.contains(s, F.lit(w)), F.lit(d)) for w, d in words))
    return F.coalesce(by(first), by(second), F.when(F.length(first) > 2, first), F.lit("general"))


def menu_path(names: Column) -> Column:
    """The first name with a slash: its first three segments."""
    first = F.get(F.filter(names, lambda n: F.contains(n, F.lit("/"))), F.lit(0))
    return F.array_join(F.slice(F.filter(F.split(first, "/"), lambda s: s != ""), 1, 3), " > ")


def path_prefixes(path: Column) -> Column:
    """Every leading part of a path, as an array."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.when(F.size(parts) > 0, F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).otherwise(F.array().cast("array<string>"))
