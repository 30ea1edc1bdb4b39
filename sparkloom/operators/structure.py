"""Code structure as rows: types, methods, constructors, fields, calls, and what a name refers to.

Intervals come from one scan of a file's brackets (functions.scan); a member belongs to the
type whose block holds it, a call to the method whose block holds it. Owners are looked up
by number within the row, so nothing is shuffled until rows are asked for.

Defined results: a null or empty text has no rows; blocks that are not closed end with the
text; a closing brace too many is passed over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import scan
from sparkloom.functions.extract import all_of, decision_points
from sparkloom.functions.text import statement_class, table_names
from sparkloom.operators.graph import checkpointed

MODIFIERS = ("public", "protected", "private", "static", "final", "abstract", "native", "synchronized", "transient", "volatile", "strictfp", "default", "sealed")
NAME = r"[A-Za-z_$][\w$]*"
MARK = r"@[\w.]+(?:\s*\((?:[^()]|\((?:[^()]|\([^()]*\))*\))*\))?"
BEFORE = rf"^(?:(?:{MARK}|(?:{'|'.join(MODIFIERS)})\b)\s*)*+"
KIND = r"(?:[\w.$]+(?:\s*<.*?>)?(?:\s*\[\s*\])*)"
METHOD = rf"(?s){BEFORE}(?:<[^()]*?>\s*)?({KIND})\s+({NAME})\s*\("
CONSTRUCTOR = rf"(?s){BEFORE}(?:<[^()]*?>\s*)?({NAME})\s*\("
FIELD = rf"(?s){BEFORE}({KIND})\s+({NAME})\s*(?:\[\s*\]\s*)*(?:=|,|$)"
TYPE = rf"(?s)(?:^|[\s@])(class|interface|enum|record)\s+({NAME})"


def names_of(list_: Column) -> Column:
    """`A<B, C>, D` to its parts, brackets kept together."""
    return F.filter(F.transform(F.split(list_, r",(?![^<>]*>)"), lambda x: F.trim(x)), lambda x: x != "")


def without_marks(head: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(head, MARK, " "), r"^\s+|\s+$", "")


def parameters(head: Column) -> Column:
    """array<struct<type, name>> of the last round bracket of a head without annotations."""
    inside = F.regexp_extract(without_marks(head), r"(?s)\(([^()]*)\)[^()]*$", 1)
    parts = F.transform(names_of(inside), lambda p: F.trim(F.regexp_replace(F.regexp_replace(p, r"\bfinal\s+", ""), r"\s+", " ")))
    return F.transform(parts, lambda p: F.struct(F.trim(F.regexp_extract(p, rf"^(.*?)\s*{NAME}$", 1)).alias("type"), F.regexp_extract(p, rf"({NAME})$", 1).alias("name")))


def items(files: DataFrame, text_col: str = "text") -> DataFrame:
    """files with __s, the outline; as they are where they have it."""
    return files if "__s" in files.columns else files.withColumn("__s", scan.outlined(F.col(text_col)))


AROUND = "struct<shape:string,name:string,open:int,close:int>"
EDGES = "array<struct<__of:string,to_reference:string,mapping_type:string,framework:string,attributes:map<string,string>>>"


def rows_of(files: DataFrame, path_col: str = "path", text_col: str = "text", keep: tuple[str, ...] = (), calls_too: bool = False) -> DataFrame:
    """One row a declaration: path, the columns of the files to keep, the item's fields, __inside (the text of its block),
    kind, and the parts that the patterns find; with calls_too also one a call (head its receiver) and local (left its type).

    All of a file comes from one scan of it, and no row needs the file again. The kind is told by an explode of one or
    no element, not by a filter: a filter would be pushed down and its patterns matched once more."""
    plain = files if "__s" in files.columns else files.withColumn("__s", (scan.outlined if calls_too else scan.itemized)(F.col(text_col)))
    o = plain.withColumn("__package", F.regexp_extract(text_col, r"(?m)^\s*package\s+([\w.]+)\s*;", 1))
    in_type = lambda around: around["shape"].isin("type", "anonymous")
    of = lambda number: F.get("__s.items", number)
    none = lambda kind: F.lit(None).cast(kind)
    #: What a row needs is put beside its item before the items are taken apart, so that no row carries the file.
    held = F.transform(
        "__s.items",
        lambda x, i: F.struct(
            i.cast("int").alias("number"),
            *(x[k].alias(k) for k in ("begin", "open", "close", "owner", "shape", "head", "name", "within", "start_line", "open_line", "end_line")),
            F.struct(*(of(x["owner"])[k].alias(k) for k in ("shape", "name", "open", "close"))).alias("__around"),
            F.when((x["shape"] == "block") & in_type(of(x["owner"])), F.substring(F.col(text_col), x["open"] + 2, x["close"] - x["open"] - 1)).alias("__inside"),
            none("string").alias("left"),
        ),
    )
    held = F.filter(held, lambda x: x["shape"].isin("type", "anonymous") | F.coalesce(in_type(x["__around"]), F.lit(False)))
    if calls_too:

        def other(x: Column, shape: str) -> Column:
            b = of(x["block"])
            fields = (none("int").alias("number"), x["at"].alias("begin"), F.lit(-1).alias("open"), b["close"].alias("close"), x["block"].alias("owner"), F.lit(shape).alias("shape"), none("string").alias("head"), x["right"].alias("name"), b["within"].alias("within"))
            return F.struct(*fields, *(none("int").alias(k) for k in ("start_line", "open_line", "end_line")), none(AROUND).alias("__around"), none("string").alias("__inside"), x["left"].alias("left"))

        local = F.filter("__s.declared", lambda x: F.coalesce(of(x["block"])["shape"] == "block", F.lit(False)))
        held = F.concat(held, F.transform("__s.calls", lambda x: other(x, "call")), F.transform(local, lambda x: other(x, "local")))
    rows = o.select(F.col(path_col).alias("path"), *keep, "__package", F.explode(held).alias("i")).select("path", *keep, "__package", "i.*")
    #: Step by step, so that each pattern is matched once a row.
    rows = rows.withColumn("__clean", without_marks(F.col("head")))
    rows = rows.withColumn("__bare", F.regexp_replace("__clean", r"(?s)\)\s*(?:throws|default)\s.*$", ")"))
    bare, member = F.col("__bare"), F.col("shape").isin("block", "statement")
    rows = rows.select(
        "*",
        (F.col("open") >= 0).alias("has_body"),
        (member & bare.rlike(r"^[^=(]*\(") & ((F.col("open") < 0) | bare.rlike(r"\)\s*$"))).alias("__call"),
        F.regexp_extract("__around.name", r"(\w+)$", 1).alias("__outer"),
    )
    #: Types are told by their head alone; what calls is no field.
    field = member & ~F.col("has_body") & ~F.col("__call")
    parts = (("__m1", METHOD, 1, "__call"), ("__m2", METHOD, 2, "__call"), ("__c", CONSTRUCTOR, 1, "__call"), ("__f1", FIELD, 1, None), ("__f2", FIELD, 2, None))
    rows = rows.select("*", *(F.when(F.col(test) if test else field, F.regexp_extract(bare, pattern, group)).alias(name) for name, pattern, group, test in parts))
    kind = (
        F.when((F.col("shape") == "type") & F.col("head").rlike(r"@interface\s"), "annotation")
        .when(F.col("shape") == "type", F.regexp_extract("head", TYPE, 1))
        .when(F.col("shape").isin("anonymous", "call", "local"), F.col("shape"))
        #: The name before the first round bracket; an initializer has none.
        .when(member & F.col("__call") & (F.col("__m2") != ""), "method")
        .when(member & F.col("__call") & (F.col("__c") == F.col("__outer")), "constructor")
        #: A list of constants begins as a name alone.
        .when(~F.col("has_body") & ~F.col("__call") & (F.col("__f2") != "") & ~bare.rlike(r"^[\w$]+\s*(?:\(|,|$)"), "field")
    )
    rows = rows.select("*", F.explode(F.filter(F.array(kind), lambda k: k.isNotNull())).alias("kind")).withColumnRenamed("name", "__name")
    called = F.col("kind").isin("method", "constructor")
    return rows.select(
        "*",
        F.when(~member, F.col("__name")).when(F.col("kind") == "constructor", F.col("__c")).when(F.col("kind") == "method", F.col("__m2")).otherwise(F.col("__f2")).alias("name"),
        F.col("within").alias("type_name"),
        F.nullif("__package", F.lit("")).alias("package"),
        F.when(F.col("kind") == "method", F.col("__m1")).when(F.col("kind") == "field", F.col("__f1")).alias("value_type"),
        F.when(called, parameters(bare)).alias("parameters"),
        F.col("__around.open").alias("owner_open"),
        F.col("__around.close").alias("owner_close"),
    )


def members(files: DataFrame, path_col: str = "path", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """declarations with the columns of the files to keep, and inside: the text of a method's block."""
    rows = rows_of(files, path_col, text_col, keep).withColumn("__before", F.regexp_extract("head", rf"(?s)({BEFORE})", 1))
    #: The type's own parameters may hold `extends` too.
    plain = F.when(F.col("shape") == "type", F.regexp_replace("__clean", rf"((?:class|interface|record)\s+{NAME})\s*<(?:[^<>]|<(?:[^<>]|<[^<>]*>)*>)*>", "$1"))
    rows = rows.select("*", plain.alias("__plain"))
    called = F.col("kind").isin("method", "constructor")
    return rows.select(
        "path",
        *keep,
        "number",
        "owner",
        "kind",
        "name",
        "type_name",
        "package",
        F.array_distinct(all_of(F.regexp_replace("__before", MARK, " "), rf"\b({'|'.join(MODIFIERS)})\b")).alias("modifiers"),
        F.filter(all_of(F.col("__before"), r"@([\w.]+)"), lambda a: a != "interface").alias("annotations"),
        "value_type",
        "parameters",
        F.nullif(F.regexp_extract("__plain", r"(?s)\bextends\s+(.+?)(?=\s+implements\b|\s+permits\b|$)", 1), F.lit("")).alias("extends"),
        names_of(F.regexp_extract("__plain", r"(?s)\bimplements\s+(.+?)(?=\s+permits\b|$)", 1)).alias("implements"),
        "begin",
        "open",
        "close",
        "owner_open",
        "owner_close",
        "start_line",
        "end_line",
        "has_body",
        F.when(F.col("has_body"), F.col("end_line") - F.col("open_line") + 1).otherwise(0).alias("line_count"),
        F.when(called, F.when(F.col("has_body"), decision_points(F.col("__inside"))).otherwise(1)).alias("complexity"),
        F.col("__inside").alias("inside"),
    )


def declarations(files: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """One row a type, method, constructor and field: path, number, owner, kind (class, interface, enum,
    record, annotation, anonymous, method, constructor, field), name, type_name (the types around it), package,
    modifiers, annotations, value_type, parameters, extends, implements, begin, open, close, owner_open, owner_close, start_line, end_line,
    has_body, line_count, complexity."""
    return members(files, path_col, text_col).drop("inside")


def calls(files: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """One row a call inside a method, constructor or initializer: path, at, receiver ('' for its own), name, block, type_name."""
    o = items(files, text_col)
    rows = o.select(F.col(path_col).alias("path"), "__s", F.explode("__s.calls").alias("c"))
    return rows.select("path", F.col("c.at").alias("at"), F.col("c.left").alias("receiver"), F.col("c.right").alias("name"), F.col("c.block").alias("block"), F.get("__s.items", F.col("c.block"))["within"].alias("type_name"))


def symbols(files: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """The symbol table: path, name, type, kind (field, parameter, local), and the interval (first, last) in which the name may be used."""
    d = declarations(files, path_col, text_col)
    #: A field is known in its whole type, wherever it stands.
    fields = d.where("kind = 'field'").select("path", "name", F.col("value_type").alias("type"), F.lit("field").alias("kind"), F.col("owner_open").alias("first"), F.col("owner_close").alias("last"))
    listed = d.where("has_body AND kind IN ('method', 'constructor')").select("path", F.explode("parameters").alias("p"), "open", "close").select("path", F.col("p.name").alias("name"), F.col("p.type").alias("type"), F.lit("parameter").alias("kind"), F.col("open").alias("first"), F.col("close").alias("last"))
    o = items(files, text_col)
    local = o.select(F.col(path_col).alias("path"), "__s.items", F.explode("__s.declared").alias("v")).withColumn("b", F.get("items", F.col("v.block")))
    local = local.where("b.shape = 'block'").select("path", F.col("v.right").alias("name"), F.col("v.left").alias("type"), F.lit("local").alias("kind"), F.col("v.at").alias("first"), F.col("b.close").alias("last"))
    return fields.unionByName(listed).unionByName(local)


def base_type(kind: Column) -> Column:
    """A type without its arguments, arrays and package."""
    return F.regexp_extract(F.regexp_replace(kind, r"(?s)<.*$|\[.*$|\s", ""), r"([\w$]+)$", 1)


def resolved_calls(files: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """calls with target_type and via: the declared type of the receiver's first name, from the innermost declaration
    that holds the call (of one interval the last before it); a capital name is a type itself; '' and `this` are the own type."""
    return resolved(files, path_col, text_col).drop("package")


def resolved(files: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """resolved_calls with the package of the file. The calls and declarations of one name in one file meet in one
    group; nothing is broadcast, and nothing is held but the rows of that name."""
    rows = rows_of(files, path_col, text_col, calls_too=True)
    of_symbol, of_call = "struct<first:int,last:int,type:string,kind:string>", "struct<at:int,receiver:string,name:string,block:int,type_name:string>"
    first = F.regexp_extract(F.regexp_replace("left", r"^(?:this|super)[.]", ""), r"^([\w$]+)", 1)

    def symbol(name: Column, kind: str, type_: Column, since: str, until: str) -> Column:
        return F.struct(name.alias("key"), F.struct(F.col(since).alias("first"), F.col(until).alias("last"), type_.alias("type"), F.lit(kind).alias("kind")).alias("s"), F.lit(None).cast(of_call).alias("c"))

    call = F.struct(first.alias("key"), F.lit(None).cast(of_symbol).alias("s"), F.struct(F.col("begin").alias("at"), F.col("left").alias("receiver"), "name", F.col("owner").alias("block"), "type_name").alias("c"))
    entries = (
        #: A field is known in its whole type, wherever it stands.
        F.when(F.col("kind") == "field", F.array(symbol(F.col("name"), "field", F.col("value_type"), "owner_open", "owner_close")))
        .when(F.col("kind").isin("method", "constructor") & F.col("has_body"), F.transform("parameters", lambda p: symbol(p["name"], "parameter", p["type"], "open", "close")))
        .when(F.col("kind") == "local", F.array(symbol(F.col("name"), "local", F.col("left"), "begin", "close")))
        .when(F.col("kind") == "call", F.array(call))
    )
    met = rows.select("path", "package", F.explode(entries).alias("e")).groupBy("path", "package", F.col("e.key").alias("__first")).agg(F.collect_list("e.s").alias("s"), F.collect_list("e.c").alias("c"))
    #: Of the declarations that hold the call the innermost begins last.
    holds = lambda c: F.array_max(F.transform(F.filter("s", lambda s: c["at"].between(s["first"], s["last"])), lambda s: F.struct(s["first"].alias("first"), (s["kind"] != "field").alias("inner"), s["type"].alias("type"), s["kind"].alias("kind"))))
    joined = met.select("path", "package", "__first", F.explode(F.transform("c", lambda c: F.struct(c.alias("c"), holds(c).alias("b")))).alias("x")).select("path", "package", "__first", "x.c.*", "x.b")
    own, static = F.col("__first").isin("", "this", "super"), F.col("__first").rlike("^[A-Z]")
    target = F.when(own, F.regexp_extract("type_name", r"(\w+)$", 1)).when(F.col("b").isNotNull(), base_type(F.col("b.type"))).when(static, F.col("__first"))
    via = F.when(own, "own").when(F.col("b").isNotNull(), F.col("b.kind")).when(static, "static").otherwise("unknown")
    return joined.select("path", "package", "at", "receiver", "name", "block", "type_name", target.alias("target_type"), via.alias("via"))


def matches(text: Column, pattern: Column) -> Column:
    """*x* within, *x at the end, x* at the start, a pattern with .* anywhere, else equal. Patterns are a column."""
    bare = F.regexp_replace(pattern, r"^\*|\*$", "")
    starts, ends = F.startswith(pattern, F.lit("*")), F.endswith(pattern, F.lit("*"))
    return F.when(starts & ends, F.contains(text, bare)).when(starts, F.endswith(text, bare)).when(ends & ~F.endswith(pattern, F.lit(".*")), F.startswith(text, bare)).when(F.contains(pattern, F.lit(".*")), F.regexp_like(text, pattern)).otherwise(text == pattern)


def first_match(text: Column, patterns: Column) -> Column:
    """The first of the patterns (an array column, in order) that fits, or null."""
    return F.get(F.filter(patterns, lambda p: matches(text, p)), F.lit(0))


def factory_methods(files: DataFrame, patterns: list[str], path_col: str = "path", text_col: str = "text") -> DataFrame:
    """Static methods of which `static name()` or the name fits a pattern: path, type_name, name, value_type, start_line, matched_pattern."""
    p = F.array(*map(F.lit, patterns))
    m = declarations(files, path_col, text_col).where("kind = 'method' AND array_contains(modifiers, 'static')")
    fits = F.get(F.filter(p, lambda x: matches(F.concat(F.lit("static "), "name", F.lit("()")), x) | matches(F.col("name"), x)), F.lit(0))
    return m.select("path", "type_name", "name", "value_type", "start_line", fits.alias("matched_pattern")).where("matched_pattern IS NOT NULL")


def type_interfaces(files: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """What the implements clause of each type says: path, type_name, interface, start_line."""
    d = declarations(files, path_col, text_col).where("kind IN ('class', 'enum', 'record')")
    return d.select("path", "type_name", F.explode("implements").alias("interface"), "start_line")


def manager_usage(files: DataFrame, patterns: list[str], path_col: str = "path", text_col: str = "text") -> DataFrame:
    """Calls whose receiver's declared type fits a pattern: path, type_name, manager_class, name, via, matched_pattern."""
    r = resolved_calls(files, path_col, text_col).where("via != 'own' AND target_type IS NOT NULL")
    return r.select("path", "type_name", "at", F.col("target_type").alias("manager_class"), "name", "via", first_match(F.col("target_type"), F.array(*map(F.lit, patterns))).alias("matched_pattern")).where("matched_pattern IS NOT NULL")


def orchestration(files: DataFrame, patterns: list[str], path_col: str = "path", text_col: str = "text") -> DataFrame:
    """One row a type with managers: path, type_name, manager_fields, manager_calls, unique_managers, score, is_orchestrator."""
    p = F.array(*map(F.lit, patterns))
    f = declarations(files, path_col, text_col).where("kind = 'field'").withColumn("manager", base_type(F.col("value_type"))).where(first_match(F.col("manager"), p).isNotNull())
    used = f.select("path", "type_name", "manager", F.lit(1).alias("f"), F.lit(0).alias("c")).unionByName(manager_usage(files, patterns, path_col, text_col).select("path", "type_name", F.col("manager_class").alias("manager"), F.lit(0).alias("f"), F.lit(1).alias("c")))
    return managed(used)


def managed(used: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """used: path, type_name, manager, f and c (how often as field and as call). One row a type."""
    g = used.groupBy("path", *also, "type_name").agg(F.sum("f").alias("manager_fields"), F.sum("c").alias("manager_calls"), F.count_distinct("manager").alias("unique_managers"))
    return g.select("*", (F.col("manager_fields") + F.col("manager_calls")).alias("score"), (F.col("unique_managers") > 1).alias("is_orchestrator"))


def edges(files: DataFrame, patterns: list[str], path_col: str = "path", text_col: str = "text") -> DataFrame:
    """Code edges that need structure: path, package, from_reference, to_reference, mapping_type, framework, attributes.

    method_call (a method to the target type's method), factory_method (to what it gives), interface_implementation,
    service_dependency (a type to the manager's method), orchestration, sql_table_access and stored_procedure_call
    (the method that holds the statement to the table or procedure)."""
    listed = F.array(*map(F.lit, patterns))
    told = lambda **v: F.map_from_arrays(F.array(*map(F.lit, v)), F.array(*(c.cast("string") for c in v.values())))
    nothing = F.lit(None).cast("map<string,string>")

    def made(of: Column, to: Column, kind: str, framework: str, attributes: Column = nothing) -> Column:
        """An edge; kind `manager` is a use of a manager, of which the orchestration is counted."""
        return F.struct(of.alias("__of"), to.alias("to_reference"), F.lit(kind).alias("mapping_type"), F.lit(framework).alias("framework"), attributes.alias("attributes"))

    def only(test: Column, *edges: Column) -> Column:
        return F.when(F.coalesce(test, F.lit(False)), F.array(*edges)).otherwise(F.array().cast(EDGES))

    own, here, kind = F.col("type_name"), F.concat_ws(".", "type_name", "name"), F.col("kind")
    dotted, fits = F.concat_ws(".", "target_type", "name"), F.col("__fits")
    called = resolved(files, path_col, text_col).where("via != 'own' AND target_type IS NOT NULL").withColumn("__fits", first_match(F.col("target_type"), listed))
    of_calls = F.concat(
        F.array(made(own, dotted, "method_call", "java", told(call_type=F.when(F.col("via") == "static", "static").otherwise("instance")))),
        only(fits.isNotNull(), made(own, dotted, "service_dependency", "custom", told(matched_pattern=fits)), made(own, F.col("target_type"), "manager", "call")),
    )
    d = members(files, path_col, text_col).withColumn("__manager", F.when(kind == "field", base_type(F.col("value_type"))))
    #: Static methods of which `static name()` or the name fits.
    factory = F.when((kind == "method") & F.array_contains("modifiers", "static"), F.get(F.filter(listed, lambda x: matches(F.concat(F.lit("static "), "name", F.lit("()")), x) | matches(F.col("name"), x)), F.lit(0)))
    body = F.when((kind == "method") & F.col("has_body"), F.concat(F.lit("{"), "inside"))
    d = d.select("*", factory.alias("__factory"), F.coalesce(all_of(body, r"(?i)\"\s*((?:SELECT|INSERT|UPDATE|DELETE)\s[^\"]*)\""), F.array()).alias("__sql"), F.coalesce(all_of(body, r"\{\s*(?:\?\s*=\s*)?call\s+([\w.]+)"), F.array()).alias("__procs"))
    of_members = F.concat(
        only(F.col("__factory").isNotNull(), made(here, F.col("value_type"), "factory_method", "custom", told(matched_pattern=F.col("__factory")))),
        F.when(kind.isin("class", "enum", "record"), F.transform("implements", lambda i: made(own, i, "interface_implementation", "custom"))).otherwise(F.array().cast(EDGES)),
        F.flatten(F.transform("__sql", lambda q: F.transform(table_names(q), lambda t: made(here, t, "sql_table_access", "database", told(statement_type=statement_class(q)))))),
        F.transform("__procs", lambda x: made(here, x, "stored_procedure_call", "database")),
        only(first_match(F.col("__manager"), listed).isNotNull(), made(own, F.col("__manager"), "manager", "field")),
    )
    every = d.select("path", "package", F.explode(of_members).alias("e")).unionByName(called.select("path", "package", F.explode(of_calls).alias("e")))
    #: Narrow rows, written once: what is an edge, and what counts for the orchestration.
    every = checkpointed(every.select("path", "package", "e.*"))
    uses = every.where("mapping_type = 'manager'").select("path", "package", F.col("__of").alias("type_name"), F.col("to_reference").alias("manager"), *((F.col("framework") == k).cast("int").alias(n) for k, n in (("field", "f"), ("call", "c"))))
    groups = managed(uses, ("package",)).where("is_orchestrator")
    groups = groups.select("path", "package", own.alias("__of"), F.lit("ORCHESTRATION_PATTERN").alias("to_reference"), F.lit("orchestration").alias("mapping_type"), F.lit("custom").alias("framework"), told(orchestration_score=F.col("score"), unique_manager_count=F.col("unique_managers")).alias("attributes"))
    found = every.where("mapping_type != 'manager'").unionByName(groups)
    return found.select("path", "package", F.concat_ws(".", "package", "__of").alias("from_reference"), "to_reference", "mapping_type", "framework", "attributes")
