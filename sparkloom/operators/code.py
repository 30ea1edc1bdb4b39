"""Edges out of source code (path, text), by patterns. Each kind is one explode; all kinds are a union.

Every edge has from_reference (the first type of the file, qualified), to_reference,
mapping_type and framework, as configuration edges have.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.extract import all_of

#: Annotations by what they mark.
INJECTION = ("Autowired", "Inject", "EJB", "Resource", "PersistenceContext")
COMPONENTS = ("Component", "Service", "Repository", "Controller", "RestController", "Configuration")
ENTITY_LINKS = ("OneToOne", "OneToMany", "ManyToOne", "ManyToMany")
ADVICE = ("Before", "After", "Around", "AfterReturning", "AfterThrowing")
PRIMITIVE = ("int", "long", "double", "float", "boolean", "byte", "short", "char", "void", "String", "Integer", "Long", "Double", "Boolean", "Object", "BigDecimal", "Date")
VERBS = ("GET", "POST", "PUT", "DELETE", "PATCH", "HEAD", "OPTIONS")
#: Layers by what a source file says, the first that fits.
LAYER_SIGNS = (
    ("UI", ("HttpServlet", "ActionForm", "@Controller", "ManagedBean")),
    ("Service", ("@Service", "@Stateless", "@Stateful", "Manager")),
    ("Database", ("@Repository", "EntityManager", "PreparedStatement", "JdbcTemplate")),
    ("Integration", ("@WebService", "RestTemplate", "JmsTemplate", "@MessageDriven")),
    ("Utility", ("Utils", "Helper")),
)


def typed(docs: DataFrame) -> DataFrame:
    """Adds __own: the qualified name of the first type."""
    t = F.col("text")
    package = F.nullif(F.regexp_extract(t, r"(?m)^\s*package\s+([\w.]+)\s*;", 1), F.lit(""))
    name = F.nullif(F.regexp_extract(t, r"\b(?:class|interface|enum|@interface)\s+(\w+)", 1), F.lit(""))
    return docs.withColumn("__own", F.concat_ws(".", package, name)).where(name.isNotNull())


def _edges(df: DataFrame, found: Column, kind: str, framework: str = "java") -> DataFrame:
    return df.select("path", F.col("__own").alias("from_reference"), F.explode(F.array_distinct(found)).alias("to_reference"), F.lit(kind).alias("mapping_type"), F.lit(framework).alias("framework")).where("to_reference != ''")


def _marked(names: tuple[str, ...], rest: str) -> str:
    return rf"@(?:{'|'.join(names)})\b(?:\([^)]*\))?\s+{rest}"


FIELD = r"(?:(?:public|protected|private|static|final|transient)\s+)*([\w.]+(?:<[^>]*>)?)\s+\w+\s*[;=]"


def element_type(kind: Column) -> Column:
    """What a collection holds, else the type itself."""
    inner = F.regexp_extract(kind, r"<(?:[\w.]+\s*,\s*)?([\w.]+)>", 1)
    return F.when(inner != "", inner).otherwise(F.regexp_replace(kind, "<.*$", ""))


def inheritance(df: DataFrame) -> DataFrame:
    t = F.col("text")
    up = all_of(t, r"\bclass\s+\w+(?:<[^>]*>)?\s+extends\s+([\w.]+)")
    listed = F.flatten(F.transform(all_of(t, r"\bimplements\s+([\w.,\s<>]+?)\s*\{"), lambda x: F.transform(F.split(x, r"\s*,\s*"), lambda y: F.regexp_replace(y, r"<.*$", ""))))
    return _edges(df, up, "extends").unionByName(_edges(df, listed, "implements"))


def injections(df: DataFrame) -> DataFrame:
    return _edges(df, F.transform(all_of(F.col("text"), _marked(INJECTION, FIELD)), element_type), "injects")


def field_references(df: DataFrame) -> DataFrame:
    fields = F.transform(all_of(F.col("text"), r"(?m)^\s*(?:public|protected|private)\s+" + FIELD), element_type)
    return _edges(df, F.filter(fields, lambda x: ~x.isin(*PRIMITIVE)), "references")


def calls(df: DataFrame) -> DataFrame:
    t = F.col("text")
    return _edges(df, all_of(t, r"\b([A-Z]\w+[.][a-z]\w*)\s*\("), "static_call").unionByName(_edges(df, all_of(t, r"\b([a-z]\w*[.][a-z]\w*)\s*\("), "instance_call"))


def entity_links(df: DataFrame) -> DataFrame:
    """One edge kind an annotation, to the element type of collections."""
    return reduce(DataFrame.unionByName, (_edges(df, F.transform(all_of(F.col("text"), rf"@{a}\b(?:\((?:[^()]|\([^()]*\))*\))?\s+(?:@\w+(?:\([^)]*\))?\s+)*{FIELD}"), element_type), a, "jpa") for a in ENTITY_LINKS))


def entity_tables(df: DataFrame) -> DataFrame:
    return _edges(df, all_of(F.col("text"), r"@Table\([^)]*?name\s*=\s*\"([^\"]+)\""), "entity_table", "jpa")


def components(df: DataFrame) -> DataFrame:
    return _edges(df, all_of(F.col("text"), rf"@({'|'.join(COMPONENTS)})\b"), "component", "spring")


def endpoints(df: DataFrame) -> DataFrame:
    """path, verb, from_reference and full path of each method that answers one, its class's path before it."""
    t = F.col("text")
    head = F.regexp_extract(t, r"(?s)^(.*?)\b(?:class|interface)\s+\w+", 1)
    base = F.regexp_extract(head, r"@Path\(\s*\"([^\"]*)\"", 1)
    method = rf"(?s)((?:@\w+(?:\([^)]*\))?\s+)*@(?:{'|'.join(VERBS)})\b\s*(?:@\w+(?:\([^)]*\))?\s+)*)(?:public|protected)\s[^(;{{]*?(\w+)\s*\("
    rows = df.select("path", F.col("__own").alias("from_reference"), base.alias("__base"), F.explode(F.arrays_zip(F.regexp_extract_all(t, F.lit(method), F.lit(1)).alias("a"), F.regexp_extract_all(t, F.lit(method), F.lit(2)).alias("m"))).alias("x"))
    own = F.regexp_extract("x.a", r"@Path\(\s*\"([^\"]*)\"", 1)
    return rows.select("path", "from_reference", F.col("x.m").alias("method"), F.regexp_extract("x.a", rf"@({'|'.join(VERBS)})\b", 1).alias("verb"), F.regexp_replace(F.regexp_replace(F.concat_ws("/", F.lit(""), "__base", own), "/+", "/"), "(.)/$", "$1").alias("full_path"))


def advice(df: DataFrame) -> DataFrame:
    """Advice to the class and method of its pointcut."""
    targets = F.transform(all_of(F.col("text"), rf"@(?:{'|'.join(ADVICE)})\(\s*\"execution\(([^\"]*)\)\""), pointcut_target)
    return _edges(df, targets, "advice", "aop")


def pointcut_target(expression: Column) -> Column:
    """`* a.b.C.m(..)` to a.b.C.m."""
    return F.regexp_extract(expression, r"([\w.*]+)\s*\(", 1)


def lookups(df: DataFrame) -> DataFrame:
    t = F.col("text")
    return _edges(df, all_of(t, r"\.lookup\(\s*\"([^\"]+)\""), "lookup", "jndi").unionByName(_edges(df, all_of(t, r"\b(\w+Factory)[.](?:get|create)\w*\("), "factory"))


def roles(df: DataFrame) -> DataFrame:
    inside = F.flatten(F.transform(all_of(F.col("text"), r"@(?:RolesAllowed|Secured)\(\s*(\{[^}]*\}|\"[^\"]*\")"), lambda x: F.regexp_extract_all(x, F.lit(r"\"([^\"]+)\""), F.lit(1))))
    checks = all_of(F.col("text"), r"\b(?:isUserInRole|hasRole|checkRole)\(\s*\"([^\"]+)\"")
    return _edges(df, inside, "secured").unionByName(_edges(df, checks, "security_check"))


def sql_executions(df: DataFrame) -> DataFrame:
    """Rows of SQL, procedure and dynamic calls: path, from_reference, kind, text, line."""
    t = F.col("text")
    kinds = (("sql", r"\"(\s*(?:SELECT|INSERT|UPDATE|DELETE|select|insert|update|delete)\s[^\"]*)\""), ("procedure", r"\{\s*(?:\?\s*=\s*)?call\s+([\w.]+)"), ("dynamic", r"\.(?:executeQuery|executeUpdate|execute)\(\s*(\w+)\s*\)"))
    parts = []
    for kind, pattern in kinds:
        rows = df.select("path", F.col("__own").alias("from_reference"), F.posexplode(F.split(t, "\n")).alias("at", "__l"))
        parts.append(rows.where(F.col("__l").rlike(pattern)).select("path", "from_reference", F.lit(kind).alias("kind"), F.regexp_extract("__l", pattern, 1).alias("text"), (F.col("at") + 1).alias("line")))
    return reduce(DataFrame.unionByName, parts)


def orchestrators(df: DataFrame, pattern: str = r"\b(\w+(?:Manager|Service))\b\s+\w+\s*[;=]") -> DataFrame:
    """Types with more than one distinct collaborator, and how many."""
    found = F.array_distinct(all_of(F.col("text"), pattern))
    return df.select("path", F.col("__own").alias("from_reference"), F.size(found).alias("score")).where("score > 1")


def layer_of(text: Column, signs=LAYER_SIGNS) -> Column:
    from sparkloom.functions.classify import indicator_match

    return indicator_match(text, [(n, list(w)) for n, w in signs], "Other")


def code_mappings(docs: DataFrame, packages: list[str] | None = None) -> DataFrame:
    """All kinds of edges; with a list of packages only those to them (a target without one is left out)."""
    df = typed(docs)
    parts = [inheritance(df), injections(df), field_references(df), calls(df), entity_links(df), entity_tables(df), components(df), advice(df), lookups(df), roles(df)]
    every = reduce(DataFrame.unionByName, parts)
    if packages:
        every = every.where(reduce(lambda a, b: a | b, (F.startswith("to_reference", F.lit(p + ".")) for p in packages)))
    return every
