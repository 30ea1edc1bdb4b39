"""What lies inside what in source code: blocks, statements of types, calls and declarations, by one scan of the brackets.

Strings and comments are blanked out first, letter by letter, so places stay those of the
text. The rest is a stack of brackets: a block is known by the text before its brace (its
head), its interval, and the block around it. Classification of heads is left to columns.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

HIDDEN = re.compile(r'//[^\n]*|/\*.*?(?:\*/|\Z)|"""(?:\\.|.)*?(?:"""|\Z)|"(?:\\.|[^"\\\n])*"?|\'(?:\\.|[^\'\\\n])*\'?', re.S)
SIGNS = re.compile(r"[{}();]")
TYPE = re.compile(r"(?:^|[\s@])(?:class|interface|enum|record)\s+([A-Za-z_$][\w$]*)")
ANONYMOUS = re.compile(r"\bnew\s+([\w.$]+)\s*(?:<[^{}]*>)?\s*\((?:[^()]|\([^()]*\))*\)\s*$")
#: Behind such a head a brace begins a value, and the statement goes on behind it.
VALUE = re.compile(r"(?:[=(,\]>{]|\breturn)\s*$|\bnew\s[^;]*\)\s*$")
CALL = re.compile(r"(?<![\w@.$])((?:[A-Za-z_$][\w$]*(?:\(\))?\s*\.\s*)*)([A-Za-z_$][\w$]*)\s*\(")
DECLARED = re.compile(r"(?<![\w@.$])((?:[A-Za-z_$][\w$]*\.)*[A-Z][\w$]*(?:<[^;=(){}]*>)?(?:\[\])*)\s+([a-z_$][\w$]*)\s*(?=[=;:,)])")
#: Words before a bracket that are no calls.
NO_CALLS = frozenset(("if", "for", "while", "switch", "catch", "try", "synchronized", "return", "throw", "new", "assert", "super", "this"))
NEW = re.compile(r"\bnew\s+$")


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in fields.items()])


_PLACED = T.ArrayType(_struct(at=T.IntegerType(), block=T.IntegerType(), left=T.StringType(), right=T.StringType()))
_ITEMS = T.ArrayType(_struct(begin=T.IntegerType(), open=T.IntegerType(), close=T.IntegerType(), owner=T.IntegerType(), shape=T.StringType(), head=T.StringType(), name=T.StringType(), within=T.StringType(), start_line=T.IntegerType(), open_line=T.IntegerType(), end_line=T.IntegerType()))
OUTLINE = _struct(items=_ITEMS, calls=_PLACED, declared=_PLACED)


def masked(text: str) -> str:
    """The text with strings and comments blanked out; line ends stay."""
    return HIDDEN.sub(lambda m: re.sub(r"[^\n]", " ", m[0]), text)


def blocks(code: str) -> list[tuple]:
    """(begin, open, close, owner, shape, head, name, within) of each block, and of each statement (open -1) that stands in a type or in none.
    shape: type, anonymous (a type without name), block, or statement. name: of types. within: the names of the types around it and its own."""
    items: list[list] = []
    stack: list[tuple[int, int]] = []  # (number of the block, where its statement began), -1 for a round bracket
    begin = resume = 0

    def owner() -> int:
        return next((k for k, _ in reversed(stack) if k >= 0), -1)

    def start(at: int, end: int) -> int:
        return end - len(code[at:end].lstrip())

    for sign in SIGNS.finditer(code):
        at = sign.start()
        if sign[0] == "(":
            stack.append((-1, begin))
        elif sign[0] == ")":
            if stack and stack[-1][0] < 0:
                stack.pop()
        elif sign[0] == "{":
            head = code[max(begin, resume) : at]
            named, made, around = TYPE.search(head), ANONYMOUS.search(head), owner()
            shape, name = ("type", named[1]) if named else ("anonymous", f"{made[1]}$anonymous") if made else ("block", None)
            outer = items[around][7] if around >= 0 else ""
            items.append([start(max(begin, resume), at), at, len(code), around, shape, head.strip(), name, f"{outer}.{name}".lstrip(".") if name else outer])
            stack.append((len(items) - 1, begin))
            begin = resume = at + 1
        elif sign[0] == "}":
            while stack and stack[-1][0] < 0:
                stack.pop()
            if not stack:
                begin = resume = at + 1
                continue
            number, before = stack.pop()
            items[number][2] = at
            goes_on = items[number][4] != "type" and (VALUE.search(items[number][5]) or stack and stack[-1][0] < 0)
            begin, resume = (before, at + 1) if goes_on else (at + 1, at + 1)
        elif not stack or stack[-1][0] >= 0:
            around = owner()
            if around < 0 or items[around][4] in ("type", "anonymous"):
                items.append([start(begin, at), -1, at, around, "statement", code[begin:at].split("{", 1)[0].strip(), None, items[around][7] if around >= 0 else ""])
            begin = resume = at + 1
    return [tuple(i) for i in items]


def innermost(items: list[tuple]):
    """place -> number of the innermost block that holds it, or -1."""
    own = [(i[1], k) for k, i in enumerate(items) if i[1] >= 0]
    opens = [o for o, _ in own]

    def block(at: int) -> int:
        k = bisect_right(opens, at) - 1
        number = own[k][1] if k >= 0 else -1
        while number >= 0 and items[number][2] < at:
            number = items[number][3]
        return number

    return block


def placed(code: str) -> list[tuple]:
    """blocks with the lines of their begin, open and close."""
    ends = [m.start() for m in re.finditer("\n", code)]
    line = lambda at: bisect_left(ends, at) + 1
    return [(*i, line(i[0]), line(i[1]) if i[1] >= 0 else 0, line(i[2])) for i in blocks(code)]


def outline(text: str | None) -> dict:
    code = masked(text or "")
    items = placed(code)
    block = innermost(items)
    calls = [(m.start(2), block(m.start(2)), re.sub(r"\s", "", m[1]).rstrip("."), m[2]) for m in CALL.finditer(code) if m[2] not in NO_CALLS and not NEW.search(code, max(0, m.start() - 64), m.start())]
    inside = [c for c in calls if c[1] >= 0 and items[c[1]][4] == "block"]
    declared = [(m.start(2), block(m.start(2)), re.sub(r"\s+", " ", m[1]), m[2]) for m in DECLARED.finditer(code)]
    return {"items": items, "calls": inside, "declared": declared}


def lists(rows: list[list[tuple]], kind: T.ArrayType) -> pa.Array:
    """A list of structs a text, built column by column."""
    offsets, columns = [0], list(zip(*(r for own in rows for r in own))) or [()] * len(kind.elementType)
    for own in rows:
        offsets.append(offsets[-1] + len(own))
    of = to_arrow_type(kind)
    values = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, of.value_type)], fields=list(of.value_type))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, type=of)


@F.arrow_udf(OUTLINE)
def outlined(texts: pa.Array) -> pa.Array:
    found, of = [outline(t.as_py()) for t in texts], to_arrow_type(OUTLINE)
    return pa.StructArray.from_arrays([lists([o[f.name] for o in found], f.dataType) for f in OUTLINE], fields=list(of))


@F.arrow_udf(_struct(items=_ITEMS))
def itemized(texts: pa.Array) -> pa.Array:
    """The outline's items alone, which is less work."""
    return pa.StructArray.from_arrays([lists([placed(masked(t.as_py() or "")) for t in texts], _ITEMS)], fields=list(to_arrow_type(_struct(items=_ITEMS))))
