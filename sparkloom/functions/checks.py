"""Text validity: syntax counts, parity, encoding."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def balance(text: Column, opening: str, closing: str) -> Column:
    return F.regexp_count(text, F.lit(opening)) - F.regexp_count(text, F.lit(closing))


def scriptlet_balance(page: Column) -> Column:
    return balance(page, "<%", "%>")


def comment_balance(text: Column) -> Column:
    return balance(text, "<!--", "-->")


def sql_comment_balance(sql: Column) -> Column:
    return balance(sql, r"/\*", r"\*/")


def el_balance(page: Column) -> Column:
    return F.regexp_count(page, F.lit(r"\$\{")) - F.regexp_count(page, F.lit(r"\$\{[^}]*\}"))


def odd_quote_lines(text: Column) -> Column:
    """How many lines hold an odd number of double quotes."""
    return F.size(F.filter(F.split(text, "\n"), lambda x: F.length(x) % 2 != F.length(F.replace(x, F.lit('"'), F.lit(""))) % 2))


def vb_subs(text: Column) -> tuple[Column, Column]:
    return F.regexp_count(text, F.lit(r"(?im)^\s*(?:public\s+|private\s+)?(?:sub|function)\s+\w+")), F.regexp_count(text, F.lit(r"(?im)^\s*end\s+(?:sub|function)\b"))


def java_imports_bad(code: Column) -> Column:
    return F.filter(F.regexp_extract_all(code, F.lit(r"(?m)^\s*(import\b[^\n]*)$"), F.lit(1)), lambda x: ~x.rlike(r"^import\s+(?:static\s+)?[\w.]+(?:[.][*])?\s*;"))


@F.pandas_udf(T.IntegerType())
def brace_depth(texts: pd.Series) -> pd.Series:
    """Depth of braces at the end, strings left out; -1 if one closes too early."""

    def one(text):
        depth, quote, skip = 0, "", False
        for c in text or "":
            if skip:
                skip = False
            elif quote:
                skip, quote = c == "\\", "" if c == quote else quote
            elif c in "\"'":
                quote = c
            elif c == "{":
                depth += 1
            elif c == "}":
                depth -= 1
                if depth < 0:
                    return -1
        return depth

    return texts.map(one)


@F.pandas_udf(T.StringType())
def unclosed_tag(texts: pd.Series) -> pd.Series:
    """The first tag that does not nest, or null."""
    import re

    tag = re.compile(r"<(/?)([\w:.-]+)[^>]*?(/?)>")

    def one(text):
        stack = []
        for close, name, alone in tag.findall(re.sub(r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<[?!][^>]*>", "", text or "")):
            if close:
                if not stack or stack.pop() != name:
                    return name
            elif not alone:
                stack.append(name)
        return stack[-1] if stack else None

    return texts.map(one)


def null_share(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\x00")) / F.greatest(F.length(text), F.lit(1))


def control_share(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[\x00-\x08\x0B\x0C\x0E-\x1F]")) / F.greatest(F.length(text), F.lit(1))


def is_valid_text(text: Column) -> Column:
    return (null_share(text) <= 0.1) & (control_share(text) <= 0.05)


def bom(content: Column) -> Column:
    """The encoding that a byte order mark names; the longer marks first."""
    head = F.hex(F.substring(content, 1, 4))
    return F.when(F.startswith(head, F.lit("FFFE0000")), "utf-32-le").when(F.startswith(head, F.lit("0000FEFF")), "utf-32-be").when(F.startswith(head, F.lit("EFBBBF")), "utf-8-sig").when(F.startswith(head, F.lit("FFFE")), "utf-16-le").when(F.startswith(head, F.lit("FEFF")), "utf-16-be")


def encoding_of(content: Column) -> Column:
    """A mark, else UTF-8 where the bytes are valid, else Latin-1."""
    return F.coalesce(bom(content), F.when(F.is_valid_utf8(content.cast("string")), "utf-8"), F.lit("latin-1"))


@F.pandas_udf(T.StringType())
def decoded(contents: pd.Series, encodings: pd.Series) -> pd.Series:
    """Bytes in the encoding named; what does not decode is replaced."""
    return pd.Series([None if c is None else bytes(c).decode(e or "utf-8", "replace").lstrip("﻿") for c, e in zip(contents, encodings)])


def syntax_issues(language: Column, text: Column) -> Column:
    """Names of the checks of its language that a text fails."""
    subs, ends = vb_subs(text)
    rules = (
        ("java", "braces", brace_depth(text) != 0),
        ("java", "imports", F.size(java_imports_bad(text)) > 0),
        ("java", "no_type", ~text.rlike(r"\b(?:class|interface|enum|@interface)\s+\w+")),
        ("jsp", "scriptlets", scriptlet_balance(text) != 0),
        ("jsp", "expressions", el_balance(text) != 0),
        ("xml", "tags", unclosed_tag(text).isNotNull()),
        ("xml", "declaration", F.regexp_count(text, F.lit(r"<\?xml\s")) > 1),
        ("sql", "comments", sql_comment_balance(text) != 0),
        ("sql", "quotes", F.regexp_count(text, F.lit("'")) % 2 != 0),
        ("html", "comments", comment_balance(text) != 0),
        ("vbscript", "subs", subs != ends),
    )
    return F.array_compact(F.array(*(F.when((language == k) & test, F.lit(name)) for k, name, test in rules)))
