"""Edges and rows out of configuration documents (path, text), read within a row, then joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import extract
from sparkloom.functions.classify import component_type
from sparkloom.functions.paths import normalize_action, normalize_namespace


def elements(docs: DataFrame, name: str, fields: dict[str, str]) -> DataFrame:
    """path, ord and the fields of each element of this name. A malformed document gives no rows."""
    ok = docs.where(F.col("text").rlike(rf"<(?:\w+:)?{name}[\s/>]"))
    #: Elements are cut out as text first, so that fields that some lack stay with their element.
    block = F.regexp_extract_all(F.col("text"), F.lit(rf"(?s)<(?:\w+:)?{name}(?=[\s/>])(?:[^>]*/>|.*?</(?:\w+:)?{name}\s*>)"), F.lit(0))
    rows = ok.select("path", F.posexplode(block).alias("ord", "__b"))
    value = lambda f: F.nullif(F.trim(F.regexp_extract("__b", _pattern(name, f), 1)), F.lit(""))
    return rows.select("path", "ord", *(value(f).alias(alias) for alias, f in fields.items()), F.col("__b").alias("block"))


def _pattern(name: str, field: str) -> str:
    steps = field.split("/")
    if steps[-1].startswith("@"):
        inside = "".join(rf".*?<(?:\w+:)?{s}(?=[\s/>])" for s in steps[:-1])
        return rf"(?s)^<(?:\w+:)?{name}(?=[\s/>]){inside}[^>]*?\s{steps[-1][1:]}\s*=\s*[\"']([^\"']*)[\"']"
    inside = "".join(rf".*?<(?:\w+:)?{s}(?:\s[^>]*)?>" for s in steps)
    return rf"(?s)^<(?:\w+:)?{name}(?=[\s/>]){inside}([^<]*)<"


def mapping(source: Column, target: Column, kind: str, framework: str) -> list[Column]:
    return [source.alias("from_reference"), target.alias("to_reference"), F.lit(kind).alias("mapping_type"), F.lit(framework).alias("framework")]


def servlet_mappings(docs: DataFrame) -> DataFrame:
    """URL patterns to servlet classes; the last definition of a name wins."""
    servlets = elements(docs, "servlet", {"name": "servlet-name", "class": "servlet-class"}).groupBy("path", "name").agg(F.max_by("class", "ord").alias("class"))
    urls = elements(docs, "servlet-mapping", {"name": "servlet-name", "url": "url-pattern"}).select("path", "name", "url")
    return urls.join(servlets, ["path", "name"]).select("path", *mapping(F.col("url"), F.col("class"), "servlet", "servlet"))


def filter_mappings(docs: DataFrame) -> DataFrame:
    """Mapped filters by URL; filters without a mapping by their name."""
    filters = elements(docs, "filter", {"name": "filter-name", "class": "filter-class"}).select("path", "name", "class")
    urls = elements(docs, "filter-mapping", {"name": "filter-name", "url": "url-pattern"}).select("path", "name", "url")
    mapped = urls.join(filters, ["path", "name"]).select("path", *mapping(F.col("url"), F.col("class"), "filter", "servlet"))
    rest = filters.join(urls.select("path", "name").distinct(), ["path", "name"], "left_anti").select("path", *mapping(F.col("name"), F.col("class"), "filter", "servlet"))
    return mapped.unionByName(rest)


def error_pages(docs: DataFrame) -> DataFrame:
    """A status code counts before an exception type."""
    e = elements(docs, "error-page", {"code": "error-code", "type": "exception-type", "location": "location"})
    return e.select("path", *mapping(F.coalesce("code", "type"), F.col("location"), "exception", "servlet"))


def context_params(docs: DataFrame) -> DataFrame:
    return elements(docs, "context-param", {"name": "param-name", "value": "param-value"}).select("path", "name", "value")


def session_config(docs: DataFrame) -> DataFrame:
    return elements(docs, "session-config", {"timeout": "session-timeout"}).where("ord = 0").select("path", F.col("timeout").cast("int").alias("timeout"))


def action_mappings(docs: DataFrame) -> DataFrame:
    """Actions of either form; the namespace of the package around is not repeated."""
    old = elements(docs, "action", {"action": "@path", "type": "@type", "form": "@name"}).where("action IS NOT NULL AND type IS NOT NULL")
    return old.select(*mapping(normalize_action(F.col("action")), F.col("type"), "action", "struts"), F.col("form").alias("form_name"))


def packages(docs: DataFrame) -> DataFrame:
    """group_name, namespace, extends, action, class, method: actions without a class fall to the global one of that name."""
    p = elements(docs, "package", {"group_name": "@name", "namespace": "@namespace", "extends": "@extends"})
    inside = p.select("path", "group_name", normalize_namespace(F.col("namespace")).alias("namespace"), "extends", F.explode(F.regexp_extract_all("block", F.lit(r"(?s)<action\s[^>]*>"), F.lit(0))).alias("tag"))
    attribute = lambda n: F.nullif(F.regexp_extract("tag", rf"\s{n}\s*=\s*[\"']([^\"']*)[\"']", 1), F.lit(""))
    rows = inside.select("path", "group_name", "namespace", "extends", attribute("name").alias("action"), attribute("class").alias("class"), attribute("method").alias("method"))
    known = rows.where("class IS NOT NULL").groupBy("action").agg(F.min("class").alias("global_class"))
    return rows.join(known, "action", "left").select("group_name", "namespace", "extends", "action", F.coalesce("class", "global_class").alias("class"), "method")


#: Constants that matter, by a part of their name, and their category.
CONSTANTS = (("devMode", "debug"), ("action.extension", "routing"), ("objectFactory", "integration"), ("i18n", "localisation"), ("locale", "localisation"), ("multipart", "upload"), ("theme", "view"), ("custom", "configuration"))


def constants(docs: DataFrame) -> DataFrame:
    c = elements(docs, "constant", {"name": "@name", "value": "@value"})
    category = F.coalesce(*(F.when(F.contains("name", F.lit(w)), F.lit(k)) for w, k in CONSTANTS))
    return c.select("path", "name", "value", category.alias("category")).where("category IS NOT NULL")


def interceptors(docs: DataFrame) -> DataFrame:
    """Interceptors by class; a stack as one edge to the list of what it holds."""
    own = elements(docs, "interceptor", {"name": "@name", "class": "@class"}).select("path", *mapping(F.col("name"), F.col("class"), "interceptor", "struts"))
    stacks = elements(docs, "interceptor-stack", {"name": "@name"}).select("path", *mapping(F.col("name"), F.array_join(F.regexp_extract_all("block", F.lit(r"<interceptor-ref\s+name=[\"']([^\"']+)"), F.lit(1)), ","), "interceptor_stack", "struts"))
    return own.unionByName(stacks)


def template_definitions(docs: DataFrame) -> DataFrame:
    """A path counts before a template."""
    d = elements(docs, "definition", {"name": "@name", "of": "@path", "template": "@template", "parent": "@extends"})
    kind = F.when(F.col("of").isNotNull(), "template").otherwise("reference")
    return d.select("path", F.col("name").alias("from_reference"), F.coalesce("of", "template", "parent").alias("to_reference"), kind.alias("mapping_type"), F.lit("tiles").alias("framework"), "parent")


def extends_edges(docs: DataFrame) -> DataFrame:
    return template_definitions(docs).where("parent IS NOT NULL").select("path", *mapping(F.col("from_reference"), F.col("parent"), "extends", "tiles"))


def tile_components(docs: DataFrame) -> DataFrame:
    """One edge a put, from definition.put, with the kind of its value."""
    d = elements(docs, "definition", {"name": "@name"}).select("path", "name", F.explode(F.regexp_extract_all("block", F.lit(r"<put(?:-attribute)?\s[^>]*>"), F.lit(0))).alias("tag"))
    attribute = lambda n: F.nullif(F.regexp_extract("tag", rf"\s{n}\s*=\s*[\"']([^\"']*)[\"']", 1), F.lit(""))
    return d.select("path", *mapping(F.concat_ws(".", "name", attribute("name")), attribute("value"), "component", "tiles"), component_type(F.coalesce(attribute("type"), F.lit("")), attribute("value")).alias("component_type"))


#: Validators whose variables are kept.
WITH_VARIABLES = ("mask", "minlength", "maxlength", "range", "intRange", "floatRange", "doubleRange", "date", "requiredif", "validwhen")


def validation_rules(docs: DataFrame) -> DataFrame:
    """One rule a form, field and validator."""
    forms = elements(docs, "form", {"form_name": "@name"}).select("form_name", F.explode(F.regexp_extract_all("block", F.lit(r"(?s)<field\s.*?</field>|<field\s[^>]*/>"), F.lit(0))).alias("b"))
    attribute = lambda n: F.regexp_extract("b", rf"(?s)^<field\s[^>]*?{n}\s*=\s*[\"']([^\"']*)[\"']", 1)
    names = F.regexp_extract_all("b", F.lit(r"<var-name>([^<]*)</var-name>"), F.lit(1))
    values = F.regexp_extract_all("b", F.lit(r"<var-value>([^<]*)</var-value>"), F.lit(1))
    rows = forms.select("form_name", attribute("property").alias("field_reference"), F.explode(F.split(attribute("depends"), r"\s*,\s*")).alias("validation_type"), F.array_join(F.zip_with(names, values, lambda a, b: F.concat_ws("=", F.trim(a), F.trim(b))), ",").alias("variables"), F.nullif(F.regexp_extract("b", r"<(?:msg|arg\d?)\s[^>]*key=[\"']([^\"']*)", 1), F.lit("")).alias("error_message_key"))
    return rows.where("validation_type != ''").withColumn("variables", F.when(F.col("validation_type").isin(*WITH_VARIABLES), F.col("variables")).otherwise(F.lit("")))


def validator_definitions(docs: DataFrame) -> DataFrame:
    """depends is split at commas, untrimmed."""
    v = elements(docs, "validator", {"name": "@name", "class": "@classname", "method": "@method", "depends": "@depends", "msg": "@msg"})
    return v.select("path", "name", "class", "method", F.split(F.coalesce("depends", F.lit("")), ",").alias("depends"), "msg")


def services(docs: DataFrame) -> DataFrame:
    """MBeans to their classes, each with its own dependencies and attributes."""
    m = elements(docs, "mbean", {"name": "@name", "code": "@code"})
    return m.select("path", *mapping(F.col("name"), F.col("code"), "service", "jboss"), F.array_join(F.regexp_extract_all("block", F.lit(r"<depends[^>]*>([^<]*)</depends>"), F.lit(1)), ",").alias("depends"), F.array_join(F.transform(F.regexp_extract_all("block", F.lit(r"<attribute\s+name=[\"']([^\"']+)"), F.lit(1)), lambda a: F.concat(F.lit("config_"), a)), ",").alias("attributes"))


def beans(docs: DataFrame) -> DataFrame:
    return elements(docs, "bean", {"id": "@id", "class": "@class"}).select("path", *mapping(F.col("id"), F.col("class"), "bean", "spring"))


def dependencies(docs: DataFrame) -> DataFrame:
    return elements(docs, "dependency", {"group": "groupId", "artifact": "artifactId", "version": "version", "scope": "scope"}).drop("block")


def framework_hints(docs: DataFrame) -> DataFrame:
    return docs.select("path", extract.config_kind(F.col("path")).alias("kind")).withColumn("framework", F.coalesce(*(F.when(F.col("kind") == k, F.lit(v)) for k, v in (("struts", "struts"), ("tiles", "tiles"), ("validation", "struts"), ("validator_rules", "struts"), ("spring", "spring"), ("jboss", "jboss"), ("web_xml", "servlet"), ("maven", "maven"), ("ant", "ant"), ("gradle", "gradle"))), F.lit("none")))


def generic_services(rows: DataFrame, id_col: str = "path") -> DataFrame:
    """Services from element rows of any markup (functions.markup): the id, from_reference, to_reference, depends, attributes.

    Each service gets what its own element holds, by the number of the element around."""
    plain = lambda name: F.col("path").rlike(rf"(?:^|/)(?:[\w.-]+:)?{name}$")
    own = rows.where(plain("mbean")).select(id_col, F.col("ord").alias("parent"), F.try_element_at("attributes", F.lit("name")).alias("from_reference"), F.try_element_at("attributes", F.lit("code")).alias("to_reference")).where("from_reference != '' AND to_reference != ''")
    inside = rows.where((plain("depends") | plain("attribute")) & (F.col("text") != "")).select(id_col, "parent", "ord", plain("depends").alias("d"), F.try_element_at("attributes", F.lit("name")).alias("key"), "text")
    held = inside.groupBy(id_col, "parent").agg(
        *(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(test, F.struct("ord", value.alias("v"))))), lambda x: x["v"]), ",").alias(name) for name, test, value in (("depends", F.col("d"), F.col("text")), ("attributes", ~F.col("d") & (F.col("key") != ""), F.concat(F.lit("config_"), "key", F.lit("="), "text"))))
    )
    return own.join(held, [id_col, "parent"], "left").select(id_col, "from_reference", "to_reference", F.coalesce("depends", F.lit("")).alias("depends"), F.coalesce("attributes", F.lit("")).alias("attributes"))
