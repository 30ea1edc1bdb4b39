"""Syntax checks of source files as rows: path, validator, severity (issue, warning), detail, line.

Each language has its list of validators, as the names in VALIDATORS say. Balance is checked
by the stack of functions.stacks, once a file; the rest are patterns over the text, in one
projection. XML attributes and namespaces come from the element rows of functions.markup.

Defined results: a null or empty text is valid, with the warning `empty`; a language that is
not known has no validators.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import markup, stacks
from sparkloom.functions.extract import all_of

#: Language by ending.
ENDINGS = {"java": "java", "jsp": "jsp", "jspx": "jsp", "js": "javascript", "jsx": "javascript", "xml": "xml", "xhtml": "xml", "html": "html", "htm": "html", "sql": "sql", "vbs": "vbscript", "asp": "vbscript"}
#: Words that make a statement one.
STATEMENT = r"(?i)SELECT|INSERT|UPDATE|DELETE|CREATE|ALTER|DROP"
PACKAGE = r"(?m)^[ \t]*package[ \t]+([a-zA-Z_]\w*(?:\.[a-zA-Z_]\w*)*)[ \t]*;"
IMPORT = r"^\s*import\s+(?:static\s+)?[a-zA-Z_]\w*(?:\.[a-zA-Z_*]\w*)*\s*;"
DECLARATION = r"(?s)^<\?xml\s+version\s*=\s*[\"'][^\"']+[\"']\s*(?:encoding\s*=\s*[\"'][^\"']+[\"']\s*)?(?:standalone\s*=\s*[\"'](?:yes|no)[\"']\s*)?\?>"


def language_of(path: Column) -> Column:
    """By a path's ending."""
    ending = F.lower(F.regexp_extract(path, r"\.(\w+)$", 1))
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in ENDINGS.items() for x in pair)), ending)


def validator_of(language: Column, kind: Column, sign: Column) -> Column:
    """The validator that a fault of the stack belongs to."""
    return (
        F.when(kind == "unterminated", F.when(sign.isin("/*", "<!--", "<%--"), "comments").otherwise("string_literals"))
        .when(sign == "function", "function_syntax")
        .when(language == "jsp", F.when(sign == "<%@", "directive_syntax").when(sign == "<%=", "expression_syntax").when(sign.isin("${", "#{", "}"), "el_syntax").when(F.contains(sign, F.lit("jsp:")), "tag_syntax").otherwise("scriptlet_syntax"))
        .when(language.isin("xml", "html"), "balanced_tags")
        .when(sign.isin("{", "}"), "balanced_braces")
        .when(sign.isin("(", ")"), "balanced_parentheses")
        .when(sign.isin("[", "]"), "balanced_brackets")
        .when(F.lower(sign).rlike("sub|function"), "sub_function_syntax")
        .otherwise("end_statements")
    )


def balance(files: DataFrame) -> DataFrame:
    """Faults of the stack as rows."""
    f = files.select("path", "language", F.explode(stacks.faults(F.col("text"), F.col("language"))).alias("f"))
    return f.select("path", validator_of(F.col("language"), F.col("f.kind"), F.col("f.sign")).alias("validator"), F.lit("issue").alias("severity"), F.concat_ws(" ", "f.kind", "f.sign").alias("detail"), F.col("f.line").alias("line"))


def patterns(files: DataFrame) -> DataFrame:
    """Checks that patterns can tell, as rows without a line."""
    t, language = F.col("text"), F.col("language")
    listed = []

    def check(languages: tuple[str, ...], validator: str, severity: str, details: Column) -> None:
        """details: an array of what is wrong."""
        listed.append(F.when(language.isin(*languages), F.transform(details, lambda x: F.struct(F.lit(validator).alias("validator"), F.lit(severity).alias("severity"), x.alias("detail")))).otherwise(F.array()))
        listed[-1] = F.coalesce(listed[-1], F.array())  # a null text has no details

    told = lambda test, text: F.when(F.coalesce(test, F.lit(False)), F.array(F.lit(text))).otherwise(F.array().cast("array<string>"))
    packages = F.size(all_of(t, PACKAGE))
    begun = F.regexp_count(t, F.lit(r"(?m)^[ \t]*package\s"))
    check(("java",), "package_syntax", "issue", told(packages > 1, "multiple"))
    check(("java",), "package_syntax", "issue", told(begun > packages, "invalid"))
    check(("java",), "import_syntax", "issue", F.filter(F.transform(F.regexp_extract_all(t, F.lit(r"(?m)^[ \t]*import\s[^\n]*$"), F.lit(0)), lambda x: F.trim(x)), lambda x: ~x.rlike(IMPORT)))
    types = F.regexp_count(t, F.lit(r"\b(?:class|interface|enum)\s+\w+"))
    check(("java",), "class_syntax", "warning", told(types == 0, "none"))
    check(("java",), "class_syntax", "warning", told(types > 1, "several"))
    check(("xml", "html"), "xml_declaration", "issue", F.filter(F.regexp_extract_all(t, F.lit(r"(?s)<\?xml.*?\?>"), F.lit(0)), lambda x: ~x.rlike(DECLARATION)))
    check(("javascript",), "function_syntax", "warning", told(F.regexp_count(t, F.lit(r"\bfunction\s+\w+\s*\([^)]*\)\s*\{|\([^)]*\)\s*=>\s*\{")) == 0, "no functions"))
    #: All statements but the last end where a semicolon stands; the last should too.
    last = F.element_at(F.split(t, ";"), -1)
    check(("sql",), "statement_syntax", "warning", told(last.rlike(STATEMENT), "no semicolon"))
    odd = lambda c: F.length(t) % 2 != F.length(F.replace(t, F.lit(c), F.lit(""))) % 2
    check(("sql",), "quoted_identifiers", "issue", F.concat(told(odd("'"), "single quotes"), told(odd('"'), "double quotes")))
    check(tuple(dict.fromkeys(ENDINGS.values())), "content", "warning", told(t.isNull() | (t == ""), "empty"))
    rows = files.select("path", F.explode(F.concat(*listed)).alias("f"))
    return rows.select("path", "f.validator", "f.severity", "f.detail", F.lit(None).cast("int").alias("line"))


def attributes(files: DataFrame) -> DataFrame:
    """XML attributes without quotes and prefixes that nothing declares."""
    rows = markup.element_rows(files.where("language = 'xml'").select(F.col("path").alias("__file"), "text"), "__file", F.col("text"))
    told = lambda v, c: F.transform(c, lambda x: F.struct(F.lit(v).alias("validator"), F.concat_ws(" ", "name", x).alias("detail")))
    both = rows.select(F.col("__file").alias("path"), F.explode(F.concat(told("attribute_syntax", "unquoted"), told("namespace_syntax", "undeclared"))).alias("f"))
    return both.select("path", "f.validator", F.lit("issue").alias("severity"), "f.detail", F.lit(None).cast("int").alias("line"))


def findings(files: DataFrame) -> DataFrame:
    """files: path, language, text. One row a finding: path, validator, severity, detail, line."""
    return reduce(DataFrame.unionByName, (balance(files), patterns(files), attributes(files)))


def validated(files: DataFrame) -> DataFrame:
    """One row a file: path, language, is_valid, issues, warnings (sorted texts `validator: detail`), content_length."""
    told = lambda kind: F.array_sort(F.collect_list(F.when(F.col("severity") == kind, F.concat_ws(": ", "validator", "detail"))))
    found = findings(files).groupBy("path").agg(told("issue").alias("issues"), told("warning").alias("warnings"))
    none = F.array().cast("array<string>")
    rows = files.select("path", "language", F.length(F.coalesce("text", F.lit(""))).alias("content_length")).join(found, "path", "left")
    return rows.select("path", "language", (F.size(F.coalesce("issues", none)) == 0).alias("is_valid"), F.coalesce("issues", none).alias("issues"), F.coalesce("warnings", none).alias("warnings"), "content_length")


#: The bounds of a configuration, by path: least, most (null is open).
BOUNDS = (("llm.temperature", 0.0, 2.0), ("llm.max_tokens", 1.0, None))
PROVIDERS = ("ollama", "openai", "kong_aws", "kong_azure", "kong_gcp")


def config_errors(values: DataFrame, id_col: str, required: tuple[str, ...] = ()) -> DataFrame:
    """Errors of configurations given as the rows of operators.trees.walked: id, field, message, value.

    Numbers outside their bounds, a provider that is not known, required paths that are missing."""
    number = F.col("value").try_cast("double")
    parts = []
    for path, least, most in BOUNDS:
        bad = number.isNull() | (number < least) | (F.lit(False) if most is None else number > most)
        parts.append(values.where((F.col("path") == path) & bad).select(id_col, F.lit(path).alias("field"), F.lit("out of bounds").alias("message"), "value"))
    parts.append(values.where((F.col("path") == "llm.provider") & ~F.coalesce(F.col("value").isin(*PROVIDERS), F.lit(False))).select(id_col, F.lit("llm.provider").alias("field"), F.lit("unknown provider").alias("message"), "value"))
    if required:
        held = values.groupBy(id_col).agg(F.collect_set(F.when(F.col("path").isin(*required), F.col("path"))).alias("h"))
        missing = held.select(id_col, F.explode(F.array_except(F.array(*map(F.lit, required)), "h")).alias("field"))
        parts.append(missing.select(id_col, "field", F.lit("missing").alias("message"), F.lit(None).cast("string").alias("value")))
    return reduce(DataFrame.unionByName, parts)
