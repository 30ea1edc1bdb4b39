"""Element trees of any markup as rows: path, depth, order, attributes, and prefixes that nothing declares.

One pass over the tags with a stack; each level of it knows the namespaces in scope. Text
between tags counts as the text of the innermost open element, up to its first child.

Defined results: a null text has no rows. A closing tag closes the nearest element of its
name and what was left open within; one that fits nothing is passed over. What is never
closed ends with the text. In HTML names count in lower case, void elements have no
content, and that of script and style is not markup.
"""

from __future__ import annotations

import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sparkloom.functions.stacks import RAW, TAG, VOID

ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Comments and declarations; the content of CDATA stays as text without angle brackets.
SKIPPED = re.compile(r"<!--.*?(?:-->|\Z)|<\?.*?(?:\?>|\Z)|<!(?!\[CDATA)[^>]*>", re.S)
CDATA = re.compile(r"<!\[CDATA\[(.*?)\]\]>", re.S)
ELEMENT = T.ArrayType(
    T.StructType(
        [
            T.StructField("ord", T.IntegerType()),
            T.StructField("parent", T.IntegerType()),
            T.StructField("depth", T.IntegerType()),
            T.StructField("path", T.StringType()),
            T.StructField("name", T.StringType()),
            T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
            T.StructField("unquoted", T.ArrayType(T.StringType())),
            T.StructField("undeclared", T.ArrayType(T.StringType())),
            T.StructField("text", T.StringType()),
        ]
    )
)


def undeclared(name: str, attributes: dict, scope: frozenset) -> list[str]:
    """Prefixes of the element and its attributes that are not in scope."""
    used = [n.split(":", 1)[0] for n in (name, *attributes) if ":" in n]
    return sorted({p for p in used if p not in scope and p not in ("xmlns", "xml")})


def elements(text: str | None, html: bool = False) -> list[tuple]:
    code = SKIPPED.sub(lambda m: " " * len(m[0]), text or "")
    code = CDATA.sub(lambda m: re.sub(r"[<>]", " ", m[1]), code)
    if html:
        code = RAW.sub(lambda m: m[1] + m[3].replace("<", " "), code)
    rows: list[list] = []
    stack: list[tuple[str, int, frozenset]] = []
    texts: dict[int, int] = {}  # open elements whose text goes on, and where it began

    def closed(number: int, at: int) -> None:
        if number in texts:
            rows[number][8] = re.sub(r"\s+", " ", code[texts.pop(number) : at]).strip()

    for m in TAG.finditer(code):
        if not m[5]:
            continue
        name = m[2].lower() if html else m[2]
        if m[1]:
            if any(s[0] == name for s in reversed(stack)):
                while True:
                    own, number, _ = stack.pop()
                    closed(number, m.start())
                    if own == name:
                        break
            continue
        if stack:
            closed(stack[-1][1], m.start())
        attributes, unquoted = {}, []
        for a in ATTRIBUTE.finditer(m[3] or ""):
            key = a[1].lower() if html else a[1]
            attributes.setdefault(key, next((g for g in a.groups()[1:] if g is not None), ""))
            if a[4] is not None:
                unquoted.append(key)
        around = stack[-1][2] if stack else frozenset()
        scope = around | {k[6:] for k in attributes if k.startswith("xmlns:")}
        parent = stack[-1][1] if stack else -1
        path = f"{rows[parent][3]}/{name}" if stack else name
        rows.append([len(rows), parent, len(stack) + 1, path, name, list(attributes.items()), unquoted, [] if html else undeclared(name, attributes, scope), ""])
        if not m[4] and not (html and name in VOID):
            stack.append((name, len(rows) - 1, scope))
            texts[len(rows) - 1] = m.end()
    for _, number, _ in reversed(stack):
        closed(number, len(code))
    return [tuple(r) for r in rows]


@F.arrow_udf(ELEMENT)
def xml_elements(texts: pa.Array) -> pa.Array:
    return columns([elements(t) for t in texts.to_pylist()])


@F.arrow_udf(ELEMENT)
def html_elements(texts: pa.Array) -> pa.Array:
    return columns([elements(t, True) for t in texts.to_pylist()])


def columns(found: list[list[tuple]]) -> pa.Array:
    """ELEMENT, built column by column: lists and maps from their offsets."""
    of, flat = to_arrow_type(ELEMENT), [r for own in found for r in own]

    def offsets(sizes) -> pa.Array:
        return pa.array(accumulate(sizes, initial=0), pa.int32())

    def built(field: pa.Field, values: list) -> pa.Array:
        inside = [x for v in values for x in v] if pa.types.is_list(field.type) or pa.types.is_map(field.type) else values
        if pa.types.is_map(field.type):
            pairs = [pa.array([x[k] for x in inside], pa.string()) for k in (0, 1)]
            return pa.MapArray.from_arrays(offsets(map(len, values)), *pairs, type=field.type)
        return pa.ListArray.from_arrays(offsets(map(len, values)), pa.array(inside, field.type.value_type), type=field.type) if inside is not values else pa.array(values, field.type)

    values = pa.StructArray.from_arrays([built(f, [r[k] for r in flat]) for k, f in enumerate(of.value_type)], fields=list(of.value_type))
    return pa.ListArray.from_arrays(offsets(map(len, found)), values, type=of)


def element_rows(df: DataFrame, id_col: str, text: Column, html: bool = False) -> DataFrame:
    """One row an element: id, ord, parent, depth, path, name, attributes, unquoted, undeclared, text."""
    return df.select(F.col(id_col), F.explode((html_elements if html else xml_elements)(text)).alias("e")).select(id_col, "e.*")


def attribute_counts(rows: DataFrame) -> DataFrame:
    """name, attribute and how many elements have it, over all rows."""
    return rows.select("name", F.explode(F.map_keys("attributes")).alias("attribute")).groupBy("name", "attribute").agg(F.count("*").alias("n"))
