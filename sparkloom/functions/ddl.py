"""A small DDL reader: tables with columns and keys, views and procedures with what they touch.

Bracket depth and quoting are beyond patterns, so statements are read in Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("columns", T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("type", T.StringType()), T.StructField("nullable", T.BooleanType()), T.StructField("default", T.StringType())]))),
    T.StructField("primary_key", T.ArrayType(T.StringType())),
    T.StructField("foreign_keys", T.ArrayType(T.StructType([T.StructField("columns", T.ArrayType(T.StringType())), T.StructField("references", T.StringType())]))),
])
WORD = r"[\w#@$.\[\]\"`]+"


def bare(name: str) -> str:
    return re.sub(r"[\[\]\"`]", "", name)


def parts_of(text: str) -> list[str]:
    """Split at commas that no bracket or quote encloses."""
    out, depth, quote, start = [], 0, "", 0
    for i, c in enumerate(text):
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"":
            quote = c
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
        elif c == "," and not depth:
            out.append(text[start:i].strip())
            start = i + 1
    return [x for x in (*out, text[start:].strip()) if x]


def inner(text: str, at: int) -> str:
    """What stands between the bracket at this place and its partner."""
    depth = 0
    for i in range(at, len(text)):
        depth += {"(": 1, ")": -1}.get(text[i], 0)
        if not depth:
            return text[at + 1 : i]
    return text[at + 1 :]


def read_table(sql: str | None) -> dict | None:
    m = re.search(rf"(?is)\bCREATE\s+(?:TEMP(?:ORARY)?\s+)?TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?({WORD})\s*(\()?", sql or "")
    if not m:
        return None
    found = {"name": bare(m[1]), "columns": [], "primary_key": [], "foreign_keys": []}
    if not m[2]:
        return found
    names = lambda text: [bare(x.split()[0]) for x in parts_of(text) if x.split()]
    for part in parts_of(inner(sql, m.end() - 1)):
        if key := re.search(r"(?is)^(?:CONSTRAINT\s+\S+\s+)?PRIMARY\s+KEY[^(]*\(([^)]*)\)", part):
            found["primary_key"] += names(key[1])
        elif key := re.search(rf"(?is)^(?:CONSTRAINT\s+\S+\s+)?FOREIGN\s+KEY\s*\(([^)]*)\)\s*REFERENCES\s+({WORD})", part):
            found["foreign_keys"].append({"columns": names(key[1]), "references": bare(key[2])})
        elif re.search(r"(?is)^(?:CONSTRAINT|UNIQUE|CHECK|INDEX|KEY)\b", part):
            continue
        elif col := re.search(rf"(?is)^({WORD})\s+(\w+(?:\s*\([^)]*\))?)(.*)$", part):
            rest, default = col[3], re.search(r"(?is)\bDEFAULT\s+('(?:[^']*)'|[\w.]+(?:\([^)]*\))?|\([^)]*\))", col[3])
            found["columns"].append({"name": bare(col[1]), "type": re.sub(r"\s+", "", col[2]).upper(), "nullable": not re.search(r"(?i)NOT\s+NULL|PRIMARY\s+KEY", rest), "default": default[1] if default else None})
            if re.search(r"(?i)\bPRIMARY\s+KEY\b", rest):
                found["primary_key"].append(bare(col[1]))
            if ref := re.search(rf"(?is)\bREFERENCES\s+({WORD})", rest):
                found["foreign_keys"].append({"columns": [bare(col[1])], "references": bare(ref[1])})
    return found


@F.pandas_udf(TABLE)
def table_of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """The table that a CREATE TABLE statement makes; all null for other statements."""
    for texts in batches:
        made = [read_table(t) or dict.fromkeys(TABLE.names) for t in texts]
        yield pd.DataFrame(made, columns=TABLE.names)


def view_columns(sql: Column) -> Column:
    """Names of a view's select list: alias, else the last part of a qualified name; the first twenty, sorted."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def names(texts: pd.Series) -> pd.Series:
        def one(t):
            m = re.search(r"(?is)\bSELECT\s+(?:DISTINCT\s+|ALL\s+|TOP\s+\d+\s+)?(.*?)\bFROM\b", t or "")
            out = [re.search(r"(?is)(?:\bAS\s+)?([\w\[\]\"`]+)\s*$", p) for p in parts_of(m[1])] if m else []
            return sorted(dict.fromkeys([bare(x[1]) for x in out if x][:20]))

        return texts.map(one)

    return names(sql)


#: Words after FROM or JOIN that are no tables.
KEYWORDS = ("select", "where", "group", "order", "inner", "left", "right", "full", "outer", "cross", "lateral", "the", "as", "on")


def tables_of(sql: Column) -> Column:
    """Sorted distinct names after FROM, JOIN, INTO and UPDATE."""
    found = F.regexp_extract_all(sql, F.lit(r"(?i)\b(?:FROM|JOIN|INTO|UPDATE)\s+([\w.\[\]\"`#]+)"), F.lit(1))
    names = F.transform(found, lambda x: F.regexp_replace(x, r"[\[\]\"`]", ""))
    return F.array_sort(F.array_distinct(F.filter(names, lambda x: (F.length(x) > 2) & ~F.lower(x).isin(*KEYWORDS))))


def operations_of(body: Column) -> Column:
    """Rows (op, table) of a procedure's body."""
    one = lambda op, pattern: F.transform(F.regexp_extract_all(body, F.lit(pattern), F.lit(1)), lambda t: F.concat_ws(":", F.lit(op), F.regexp_replace(t, r"[\[\]\"`]", "")))
    name = r"([\w.\[\]\"`#]+)"
    every = F.concat(one("INSERT", rf"(?i)\bINSERT\s+INTO\s+{name}"), one("UPDATE", rf"(?i)\bUPDATE\s+{name}"), one("DELETE", rf"(?i)\bDELETE\s+FROM\s+{name}"), one("SELECT", rf"(?i)(?<!DELETE )\bFROM\s+{name}|JOIN"))
    return F.array_sort(F.array_distinct(F.filter(every, lambda x: ~F.endswith(x, F.lit(":")))))


def procedure_of(sql: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(sql, r"(?is)\bCREATE\s+(?:OR\s+(?:REPLACE|ALTER)\s+)?PROC(?:EDURE)?\s+([\w.\[\]\"`]+)", 1), r"[\[\]\"`]", "")


def statement_type(sql: Column) -> Column:
    """By the first word, so that INSERT ... SELECT is an insert."""
    word = F.upper(F.regexp_extract(sql, r"(?is)^\s*(?:WITH\b.*?\)\s*)?(\w+)", 1))
    return F.when(word.isin("CREATE", "ALTER", "DROP", "INSERT", "UPDATE", "DELETE", "SELECT", "SET", "EXEC", "GRANT"), word).otherwise(F.lit("SELECT"))


def combined(batches, name: str, order: str, sql: str):
    """Statements of one object in order, joined by GO lines."""
    return batches.groupBy(name).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, sql))), lambda s: s[sql]), "\nGO\n").alias("body"))
