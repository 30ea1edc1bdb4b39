"""Names, roles, SQL text, JSON and Markdown: columns in, columns out."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Helper names that stand for roles, with the case to show them in.
ROLE_ALIASES = {
    "getsecurity": "getSecurity",
    "unauthorizeduse": "unauthorizedUse",
    "security": "security",
}
#: Endings of technical names that say nothing to a reader.
TECHNICAL = "Action|Controller|Servlet|Impl|Bean|Service|Manager|Handler"


def nz(value: Column) -> Column:
    return F.nullif(F.trim(value.cast("string")), F.lit(""))


def canonical_role(name: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(F.trim(name), "(?i)^role_", ""), "[^A-Za-z0-9_:.-]+", "")
    out = bare
    for key, shown in ROLE_ALIASES.items():
        out = F.when(F.lower(bare) == key, F.lit(shown)).otherwise(out)
    return F.when(nz(name).isNotNull(), out)


def role_category(role: Column) -> Column:
    return F.when(F.lower(role).isin(*ROLE_ALIASES), F.lit("helper")).when(F.startswith(F.lower(role), F.lit("level")), F.lit("level")).when(role == F.upper(role), F.lit("constant")).otherwise(F.lit("named"))


def split_roles(value: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(F.split(value, r"[,\s]+"), lambda x: F.regexp_replace(x, "^['\"]+|['\"]+$", "")), lambda x: x != ""))


def roles_in_expression(expr: Column) -> Column:
    """hasRole('A'), hasAnyRole('A', 'B'), isUserInRole("A")."""
    one = F.regexp_extract_all(expr, F.lit(r"(?:hasRole|hasAuthority|isUserInRole)\(\s*['\"]([^'\"]+)['\"]"), F.lit(1))
    many = F.flatten(F.transform(F.regexp_extract_all(expr, F.lit(r"(?:hasAnyRole|hasAnyAuthority)\(([^)]*)\)"), F.lit(1)), split_roles))
    return F.array_sort(F.array_union(one, many))


def humanize(name: Column) -> Column:
    """Separators to blanks, words of a compound apart, technical endings dropped, first letter large."""
    s = F.regexp_replace(F.trim(name), r"[_./\\-]", " ")
    s = F.regexp_replace(s, "([a-z0-9])([A-Z])", "$1 $2")
    s = F.trim(F.regexp_replace(F.regexp_replace(s, f" +(?:{TECHNICAL})$", ""), " +", " "))
    return F.concat(F.upper(F.substring(s, 1, 1)), F.substr(s, F.lit(2)))


def clean_statement(sql: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(sql, r"(?s)/\*.*?\*/", " "), r"--[^\r\n]*", ""))


def split_batches(sql: Column) -> Column:
    """At lines that hold GO alone."""
    return F.filter(F.transform(F.split(sql, r"(?im)^[ \t]*GO[ \t]*$"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")


#: The statement classes, by how a statement starts; the first that fits counts.
STATEMENTS = (
    ("SELECT", "SELECT"),
    ("INSERT", "INSERT"),
    ("UPDATE", "UPDATE"),
    ("DELETE", "DELETE"),
    ("CREATE TABLE", "CREATE_TABLE"),
    ("CREATE VIEW", "CREATE_VIEW"),
    ("CREATE INDEX", "CREATE_INDEX"),
    ("CREATE PROCEDURE", "CREATE_PROCEDURE"),
    ("CREATE FUNCTION", "CREATE_FUNCTION"),
    ("CREATE", "CREATE_OTHER"),
    ("ALTER", "ALTER"),
    ("DROP", "DROP"),
    ("GRANT", "GRANT"),
    ("REVOKE", "REVOKE"),
    ("COMMIT", "COMMIT"),
    ("ROLLBACK", "ROLLBACK"),
    ("--", "COMMENT"),
    ("/*", "COMMENT"),
)


def statement_class(sql: Column) -> Column:
    s = F.upper(F.trim(sql))
    return F.coalesce(*(F.when(F.startswith(s, F.lit(start)), F.lit(name)) for start, name in STATEMENTS), F.lit("OTHER"))


#: What stands before a table's name.
TABLE_AFTER = ("FROM", "JOIN", "INSERT INTO", "UPDATE", "DELETE FROM", "CREATE TABLE", "ALTER TABLE", "DROP TABLE")


def table_names(sql: Column) -> Column:
    found = [F.regexp_extract_all(sql, F.lit(r"(?i)\b" + k.replace(" ", r"\s+") + r"\s+([a-zA-Z_][a-zA-Z0-9_.]*)"), F.lit(1)) for k in TABLE_AFTER]
    return F.array_sort(F.array_distinct(F.concat(*found)))


def column_names(sql: Column) -> Column:
    lists = F.regexp_extract_all(sql, F.lit(r"(?is)\bSELECT\s+(.*?)\s+FROM\b"), F.lit(1))
    names = F.transform(F.flatten(F.transform(lists, lambda x: F.split(x, ","))), lambda c: F.regexp_extract(F.trim(c), r"^([a-zA-Z_][a-zA-Z0-9_.]*)", 1))
    return F.array_sort(F.array_distinct(F.filter(names, lambda n: (n != "") & ~F.upper(n).isin("DISTINCT", "ALL"))))


#: What makes a statement complex.
COMPLEX = (
    ("subqueries", r"\(\s*SELECT\b"),
    ("joins", r"\bJOIN\b"),
    ("unions", r"\bUNION\b"),
    ("cases", r"\bCASE\s+WHEN\b"),
    ("windows", r"\bOVER\s*\("),
    ("ctes", r"\bWITH\s+\w+\s+AS\b"),
)


def complexity(sql: Column) -> dict[str, Column]:
    """Counts by kind."""
    return {name: F.regexp_count(sql, F.lit("(?i)" + pattern)) for name, pattern in COMPLEX}


def object_name(sql: Column) -> Column:
    """Of CREATE, ALTER or DROP: brackets stripped, schema kept."""
    return F.regexp_replace(F.regexp_extract(sql, r"(?is)\b(?:CREATE(?:\s+OR\s+(?:REPLACE|ALTER))?|ALTER|DROP)\s+(?:UNIQUE\s+)?(?:TABLE|VIEW|INDEX|PROCEDURE|PROC|FUNCTION|TRIGGER)\s+(?:IF\s+(?:NOT\s+)?EXISTS\s+)?([\w.\[\]\"`#@]+)", 1), r"[\[\]\"`]", "")


def is_temporary(name: Column) -> Column:
    return name.rlike(r"^[#@]|(?i)^(?:tmp|temp)_")


def nested_value(document: Column, path: str, default: str | None = None) -> Column:
    found = F.get_json_object(document, "$." + path)
    return found if default is None else F.coalesce(found, F.lit(default))


def has_keys(document: Column, keys: list[str]) -> Column:
    return F.coalesce(F.size(F.array_except(F.array(*map(F.lit, keys)), F.json_object_keys(document))) == 0, F.lit(False))


@F.pandas_udf(T.StringType())
def first_json(texts: pd.Series) -> pd.Series:
    """The first balanced {...}, whatever stands in strings."""

    def one(text):
        start, depth = -1, 0
        for i, c in enumerate(text or ""):
            if c == "{":
                start, depth = (i if depth == 0 else start), depth + 1
            elif c == "}" and depth:
                depth -= 1
                if not depth:
                    return text[start : i + 1]
        return None

    return texts.map(one)


@F.pandas_udf(T.StringType())
def deep_merged(below: pd.Series, above: pd.Series) -> pd.Series:
    """JSON objects, the second over the first, key by key at every depth."""

    def merge(a, b):
        return {k: merge(a[k], b[k]) if k in a and k in b and isinstance(a[k], dict) and isinstance(b[k], dict) else b.get(k, a.get(k)) for k in [*a, *(k for k in b if k not in a)]}

    return pd.Series([json.dumps(merge(json.loads(a or "{}"), json.loads(b or "{}")), sort_keys=True) for a, b in zip(below, above)])


def heading(text: Column, level: int = 2) -> Column:
    return F.concat(F.lit("#" * max(1, min(6, level)) + " "), text)


def markdown_row(*cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(c.cast("string"), F.lit("-")) for c in cells)), F.lit(" |"))


def markdown_head(headers: list[str]) -> str:
    return "| " + " | ".join(headers) + " |\n| " + " | ".join(["---"] * len(headers)) + " |"


def hash_fraction(key: Column) -> Column:
    """First 32 bits of the MD5, modulo ten million, as a fraction."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % 10_000_000 / F.lit(1e7)
