"""Balance of brackets, blocks and tags: a stack over a language's tokens that tells where it breaks.

Strings and comments are blanked out before (an unterminated one is a fault of its own).
What opens is pushed; what closes must fit the top. If it fits something deeper, what lies
above was never closed; if it fits nothing, it came unexpected. What is left is unclosed.

A fault is struct<at, line, kind, sign>: kind is unexpected, unclosed, unterminated, or
malformed. A null text has no faults, neither has a language that is not known.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

FAULT = T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("line", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("sign", T.StringType())]))
PAIRS = {")": "(", "]": "[", "}": "{"}
#: What hides signs, by language; a group named `open` holds what was never terminated.
C_LIKE = r'//[^\n]*|/\*.*?\*/|(?P<open>/\*.*\Z)|"(?:\\.|[^"\\\n])*"|\'(?:\\.|[^\'\\\n])*\'|(?P<text>["\'])[^\n]*'
HIDDEN = {
    "java": re.compile(r'"""(?:\\.|.)*?"""|' + C_LIKE, re.S),
    "javascript": re.compile(r"`(?:\\.|[^`\\])*`|" + C_LIKE, re.S),
    "sql": re.compile(r"--[^\n]*|/\*.*?\*/|(?P<open>/\*.*\Z)|'(?:''|[^'])*'|\"(?:\"\"|[^\"])*\"|(?P<text>['\"]).*\Z", re.S),
    "vbscript": re.compile(r"'[^\n]*|\"(?:\"\"|[^\"\n])*\"|(?P<text>\")[^\n]*"),
    "jsp": re.compile(r"<%--.*?--%>|(?P<open><%--.*\Z)|<!--.*?-->", re.S),
    "xml": re.compile(r"<!--.*?-->|(?P<open><!--.*\Z)|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<![^>]*>", re.S),
    "html": re.compile(r"<!--.*?-->|(?P<open><!--.*\Z)|(?<=>)[^<]*(?=</script)|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<![^>]*>", re.S | re.I),
}
#: Tags that have no end, and those whose content is not markup (fixed values).
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
RAW = re.compile(r"(?is)(<(script|style)\b[^>]*>)(.*?)(?=</\2\s*>|\Z)")
SIGNS = re.compile(r"[(){}\[\]]")
TAG = re.compile(r"<(/?)([A-Za-z][\w:.-]*)((?:\s+(?:[^\s\"'>/=]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?|/(?!>)))*)\s*(/?)(>?)", re.S)
JSP = re.compile(r"(?P<code><%[@=!]?)|(?P<end>%>)|(?P<el>[$#]\{)|(?P<brace>[{}])|(?P<tag><(?P<slash>/?)(?P<name>jsp:\w+)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*'|<%.*?%>)*?)(?P<alone>/?)(?P<close>>|(?=<)|\Z))", re.S)
DIRECTIVE = re.compile(r"<%@\s*(?:page|include|taglib|attribute|tag|variable)(?:\s+[\w:.-]+\s*=\s*(?:\"[^\"]*\"|'[^']*'))*\s*%>")
VB_OPEN = re.compile(r"(?:(?:public|private|default)\s+)*(?:(sub|function|class)\s+\w|property\s+(?:get|let|set)\s+\w|(if)\b.*\bthen\s*$|(for)\b|(do)\b|(while)\b|(select)\s+case\b|(with)\b)", re.I)
VB_CLOSE = re.compile(r"end\s+(sub|function|class|property|if|select|with)\b|(next)\b|(loop)\b|(wend)\b", re.I)
VB_ENDS = {"next": "for", "loop": "do", "wend": "while"}
FUNCTION = re.compile(r"(?<![\w.$])function\b(?!\s*:)")


def hidden(text: str, language: str, faults: list[tuple[int, str, str]]) -> str:
    """The text with strings and comments blanked out; unterminated ones are added to the faults."""

    def blank(m: re.Match) -> str:
        groups = m.groupdict()
        if groups.get("open"):
            faults.append((m.start(), "unterminated", m[0][:2] if m[0][0] == "/" else m[0][:4]))
        elif groups.get("text"):
            faults.append((m.start(), "unterminated", m[0][0]))
        return re.sub(r"[^\n]", " ", m[0])

    if language == "html":
        text = RAW.sub(lambda m: m[1] + re.sub(r"[^\n]", " ", m[3]), text)
    return HIDDEN[language].sub(blank, text)


def machine(tokens, faults: list[tuple[int, str, str]]) -> None:
    """tokens: (place, whether it opens, key, sign). What closes must have the key of what it closes."""
    stack: list[tuple[int, str, str]] = []
    open_keys: dict[str, int] = {}
    for at, opens, key, sign in tokens:
        if opens:
            stack.append((at, key, sign))
            open_keys[key] = open_keys.get(key, 0) + 1
        elif not open_keys.get(key):
            faults.append((at, "unexpected", sign))
        else:
            while True:
                place, own, opened = stack.pop()
                open_keys[own] -= 1
                if own == key:
                    break
                faults.append((place, "unclosed", opened))
    faults += [(at, "unclosed", sign) for at, _, sign in stack]


def bracket_tokens(code: str):
    return ((m.start(), m[0] not in PAIRS, PAIRS.get(m[0], m[0]), m[0]) for m in SIGNS.finditer(code))


def tag_tokens(code: str, html: bool, faults: list[tuple[int, str, str]]):
    for m in TAG.finditer(code):
        name = m[2].lower() if html else m[2]
        if not m[5]:
            faults.append((m.start(), "malformed", f"<{m[1]}{name}"))
        elif not m[4] and not (html and name in VOID):
            yield m.start(), not m[1], name, f"<{m[1]}{name}>"


def jsp_tokens(page: str, faults: list[tuple[int, str, str]]):
    """Code marks, expressions and jsp: tags; braces within code are no expressions."""
    inside, depth = False, 0
    for m in JSP.finditer(page):
        if m["code"]:
            if m["code"] == "<%@" and not DIRECTIVE.match(page, m.start()):
                faults.append((m.start(), "malformed", "<%@"))
            inside = True
            yield m.start(), True, "%", m["code"]
        elif m["end"]:
            inside = False
            yield m.start(), False, "%", "%>"
        elif m["el"] and not inside:
            depth += 1
            yield m.start(), True, "${", m["el"]
        elif m["brace"] == "}" and depth and not inside:
            depth -= 1
            yield m.start(), False, "${", "}"
        elif m["tag"] and not inside:
            if not m["close"]:
                faults.append((m.start(), "malformed", f"<{m['slash']}{m['name']}"))
            elif not m["alone"]:
                yield m.start(), not m["slash"], m["name"], f"<{m['slash']}{m['name']}>"


def vb_tokens(code: str):
    """Blocks of words, statement by statement; `If ... Then x` on one line is no block."""
    for line in re.finditer(r"[^\n:]+", code):
        text = line[0].strip()
        at = line.start() + len(line[0]) - len(line[0].lstrip())
        if m := VB_CLOSE.match(text):
            word = next(g for g in m.groups() if g).lower()
            yield at, False, VB_ENDS.get(word, word), re.sub(r"\s+", " ", m[0])
        elif m := VB_OPEN.match(text):
            word = next((g for g in m.groups() if g), "property").lower()
            yield at, True, word, word


def malformed_functions(code: str, faults: list[tuple[int, str, str]]) -> None:
    """`function` needs a list in round brackets and a block."""
    for m in FUNCTION.finditer(code):
        head = re.compile(r"function\s*\*?\s*[\w$]*\s*").match(code, m.start())
        at, depth = head.end(), 0
        if code[at : at + 1] == "(":
            for k in SIGNS.finditer(code, at):
                depth += {"(": 1, ")": -1}.get(k[0], 0)
                if not depth:
                    at = k.end()
                    break
            if not depth and code[at:].lstrip()[:1] == "{":
                continue
        faults.append((m.start(), "malformed", "function"))


def found(text: str | None, language: str | None) -> list[tuple[int, int, str, str]]:
    """The faults of a text, by place."""
    faults: list[tuple[int, str, str]] = []
    if text and language in HIDDEN:
        code = hidden(text, language, faults)
        if language in ("java", "javascript", "sql"):
            machine(bracket_tokens(code), faults)
        elif language in ("xml", "html"):
            machine(tag_tokens(code, language == "html", faults), faults)
        elif language == "jsp":
            machine(jsp_tokens(code, faults), faults)
        else:
            machine(bracket_tokens(code), faults)
            machine(vb_tokens(code), faults)
        if language == "javascript":
            malformed_functions(code, faults)
    faults.sort()
    lines, at, rows = 1, 0, []
    for place, kind, sign in faults:
        lines += text.count("\n", at, place)
        at = place
        rows.append((place, lines, kind, sign))
    return rows


@F.arrow_udf(FAULT)
def faults(texts: pa.Array, languages: pa.Array) -> pa.Array:
    """Where the stack of a language breaks in a text."""
    return pa.array([found(t.as_py(), k.as_py()) for t, k in zip(texts, languages)], to_arrow_type(FAULT))
