"""Weighted rules: a score is a sum of pattern counts times weights, in one projection."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Content patterns and weights by language (safe for any regex engine).
LANGUAGES = {
    "html": ((r"<!DOCTYPE\s+html", 15), (r"<html\s*>", 12), (r"<head\s*>|<body\s*>", 10), (r"<div\s+|<span\s+|<p\s+", 5), (r"<script\s+.*?>", 8), (r"<style\s+.*?>", 8), (r"<link\s+.*?>", 6), (r"<meta\s+.*?>", 6)),
    "css": ((r"\.\w+\s*\{", 8), (r"#\w+\s*\{", 8), (r"\w+\s*:\s*\w+\s*;", 5), (r"@media\s+", 8), (r"@import\s+", 6), (r"@font-face\s*\{", 8), (r":hover|:focus|:active", 5)),
    "javascript": ((r"\bfunction\s+\w+\s*\(", 8), (r"\bvar\s+\w+\s*=", 5), (r"\blet\s+\w+\s*=", 6), (r"\bconst\s+\w+\s*=", 6), (r"\bdocument\.\w+", 8), (r"\bwindow\.\w+", 6), (r"\bconsole\.log", 5), (r"=>\s*\{", 4), (r"\brequire\s*\(", 6), (r"\bimport\s+.*?\bfrom\b", 6)),
    "jsp": ((r"<%@\s*page\s+", 15), (r"<%@\s*taglib\s+", 12), (r"<jsp:\w+", 12), (r"<c:\w+|<fmt:\w+|<fn:\w+", 10), (r"\$\{.*?\}", 8), (r"request\.getParameter", 5), (r"session\.getAttribute", 5), (r"pageContext\.\w+", 5)),
    "sql": ((r"\bSELECT\s+.*?\bFROM\b", 10), (r"\bINSERT\s+INTO\b", 10), (r"\bUPDATE\s+.*?\bSET\b", 10), (r"\bDELETE\s+FROM\b", 10), (r"\bCREATE\s+TABLE\b", 12), (r"\bALTER\s+TABLE\b", 8), (r"\bDROP\s+TABLE\b", 8), (r"\bWHERE\s+", 5), (r"\bJOIN\s+.*?\bON\b", 6), (r"\bGROUP\s+BY\b|\bORDER\s+BY\b", 5)),
    "xml": ((r"<\?xml\s+version", 15), (r"<!DOCTYPE\s+\w+", 10), (r"<\w+:\w+", 8), (r"xmlns:\w+\s*=", 10), (r"<!\[CDATA\[", 8), (r"</\w+>", 3)),
}
#: Presence patterns by SQL dialect.
DIALECTS = {
    "mysql": ((r"\bENGINE\s*=\s*InnoDB\b", 15), (r"\bAUTO_INCREMENT\b", 15), (r"\bCHARSET\s*=\s*utf8\b", 10)),
    "postgresql": ((r"\bSERIAL\b", 15), (r"::\w+", 10), (r"\bRETURNING\b", 10)),
    "oracle": ((r"\bVARCHAR2\b", 15), (r"\bSYSDATE\b", 12), (r"\bNVL\s*\(", 10)),
    "sqlserver": ((r"\bGETDATE\s*\(\)", 15), (r"\bIDENTITY\s*\(", 15), (r"\bTOP\s+\d+\b", 12), (r"\bSET\s+NOCOUNT\s+ON\b", 10)),
}


def count_of(text: Column, pattern: str, flags: str = "is") -> Column:
    return F.regexp_count(text, F.lit(f"(?{flags}){pattern}" if flags else pattern))


def weighted(text: Column, rules, flags: str = "is") -> Column:
    return reduce(add, (count_of(text, p, flags) * w for p, w in rules))


def scores(text: Column, families=LANGUAGES, flags: str = "is") -> dict[str, Column]:
    return {name: weighted(text, rules, flags) for name, rules in families.items()}


def best(scored: dict[str, Column], floor: int = 1) -> Column:
    """The name of the highest score (on a tie the first by name), null below the floor."""
    top = F.array_max(F.array(*(F.struct(s.cast("long").alias("s"), F.lit(-i).alias("o"), F.lit(n).alias("n")) for i, (n, s) in enumerate(sorted(scored.items())))))
    return F.when(top["s"] >= floor, top["n"])


def presence(text: Column, rules) -> Column:
    return reduce(add, (text.rlike(f"(?i){p}").cast("int") for p, _ in rules))


def bounded(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def subdomain_confidence(files: Column, layers: Column, hints: Column) -> Column:
    """0.6, more for over three files, over one layer, any hints; at most 0.9."""
    return F.least(F.lit(0.9), F.lit(0.6) + F.when(files > 3, 0.2).otherwise(0.0) + F.when(layers > 1, 0.1).otherwise(0.0) + F.when(hints > 0, 0.1).otherwise(0.0))


def provenance_confidence(ast: Column, has_type: Column, model: Column) -> Column:
    return F.round(bounded(0.6 * ast + 0.3 * F.when(has_type, 1.0).otherwise(0.5) + 0.1 * model), 4)


def capability_confidence(members: Column, answered: Column) -> Column:
    return F.least(F.lit(0.99), 0.4 + 0.05 * members + F.when(answered, 0.05).otherwise(0.0))


def confidence_boost(mean: Column, n: Column, full: float = 0.05) -> Column:
    return F.when((mean > 0.8) & (n >= 3), full).when((mean > 0.7) & (n >= 2), full * 0.7).when((mean > 0.6) & (n >= 1), full * 0.5).otherwise(0.0)


def complexity_level(subqueries: Column, joins: Column, unions: Column, cases: Column, windows: Column, ctes: Column) -> Column:
    total = subqueries * 2 + joins + unions * 2 + cases + windows * 3 + ctes * 2
    return F.when(total == 0, "simple").when(total <= 5, "moderate").when(total <= 15, "complex").otherwise("very_complex")


def page_class(text: Column) -> tuple[Column, Column, Column]:
    """Kind, confidence and complexity of a server page, from weighted counts of what it holds."""
    forms, scripts, tags, loops = (count_of(text, p) for p in (r"<form\b|<\w+:form\b", r"<%(?![@=!-])", r"<\w+:\w+", r"<c:forEach\b|<logic:iterate\b|\bfor\s*\("))
    kind = F.when(forms > 0, "form").when(loops > 0, "list").when(text.rlike(r"(?i)<\w*:?include\b|<%@\s*include"), "layout").otherwise("view")
    confidence = F.least(F.lit(0.95), 0.7 + F.when(forms > 0, 0.1).otherwise(0.0) + F.when(tags > 0, 0.1).otherwise(0.0) + F.when(loops > 0, 0.05).otherwise(0.0))
    weight = forms * 3 + scripts * 2 + tags + loops * 2
    return kind, confidence, F.when(weight < 5, "simple").when(weight > 20, "complex").otherwise("moderate")
