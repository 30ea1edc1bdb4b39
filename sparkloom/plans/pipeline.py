"""The six stages over a project tree: scan, extract, embed, link, assemble, render.

Each stage writes its tables and hands on what it reads back, so a partial run starts
from the tables of an earlier one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import classify, extract, paths, text
from sparkloom.operators import assemble, chunks, gates, graph, linking, structure, validate, vectors
from sparkloom.plans import render
from sparkloom.sources import files as source
from sparkloom.sources import sinks

STAGES = ("scan", "extract", "embed", "link", "assemble", "render")
#: Types that count as managers.
MANAGERS = ["*Manager", "*Mgr", "*Service", "create*", "get*MgrObject"]
#: Layers by path words, the first that fits.
LAYER_WORDS = [("UI", ["/web/", "/jsp/", ".jsp", ".html", "/asl/"]), ("Database", ["/dao/", "/dsl/", ".sql"]), ("Integration", ["/isl/", "/integration/"]), ("Service", ["/service/", "/gsl/"]), ("Configuration", [".xml", ".properties", ".yml"])]


@dataclass
class Run:
    spark: SparkSession
    root: str
    out: str
    extensions: list[str] | None = None
    dimension: int = 64
    least_confidence: float = 0.8
    name: str = "Project"
    #: Plug-ins: (name, stage after which it runs, function of the run).
    plugins: list[tuple[str, str, Callable[[Run], None]]] = field(default_factory=list)

    def table(self, stage: str, name: str) -> DataFrame:
        df = sinks.read_table(self.spark, self.out, stage, name)
        if df is None:
            raise FileNotFoundError(f"stage {stage} has not written {name}")
        return df

    def keep(self, df: DataFrame, stage: str, name: str) -> DataFrame:
        return sinks.write_table(df, self.out, stage, name)


def scan(run: Run) -> None:
    df = source.inventory(run.spark, run.root, run.extensions)
    path = F.concat(F.lit("/"), F.lower("path"))
    df = df.withColumn("layer", classify.indicator_match(path, LAYER_WORDS, "Other"))
    df = df.withColumn("subdomain_type", classify.subdomain_type(F.col("layer"))).withColumn("subdomain", F.element_at(F.split(paths.parent_path(F.col("path")), "/"), -1))
    run.keep(df, "scan", "files")


def extracted(run: Run) -> None:
    f = run.table("scan", "files")
    t = F.col("text")
    java = f.where("language = 'java'").select("path", *(c.alias(n) for n, c in extract.java_type(t).items()), extract.decision_points(t).alias("complexity"))
    run.keep(java, "extract", "java")
    code = f.where("language = 'java'").select("path", "text")
    run.keep(structure.declarations(code), "extract", "declarations")
    run.keep(structure.edges(code, MANAGERS), "extract", "code_edges")
    run.keep(validate.findings(f.select("path", validate.language_of(F.col("path")).alias("language"), "text")), "extract", "findings")
    pages = f.where("type = 'web'").select("path", extract.includes(t).alias("includes"), extract.links(t).alias("links"), extract.iframes(t).alias("iframes"), F.concat(extract.meta_refresh(t), extract.js_navigations(t), extract.dispatcher_calls(t)).alias("redirects"), extract.form_actions(t).alias("actions"), extract.role_tokens(t).alias("roles"), extract.form_fields(t).alias("fields"))
    run.keep(pages, "extract", "pages")
    sql = f.where("language = 'sql'").select("path", F.posexplode(text.split_batches(t)).alias("ord", "sql"))
    run.keep(sql.select("path", "ord", text.statement_class(F.col("sql")).alias("class"), text.object_name(F.col("sql")).alias("object"), text.table_names(F.col("sql")).alias("tables")), "extract", "sql")
    xml = f.where(extract.config_kind(F.col("path")).isin("web_xml", "struts")).select("path", *(c.alias(n) for n, c in (extract.web_xml(t) | extract.action_xml(t)).items()))
    run.keep(xml, "extract", "config")


def embed(run: Run) -> None:
    """Chunks by structure: one a class, method and page, a line for a configuration file, other files whole."""
    made = chunks.chunks(run.table("scan", "files"), ["path", "language", "type", "subdomain", "subdomain_type", "layer"])
    cache = sinks.read_table(run.spark, run.out, "embed", "cache")
    if cache is None:
        cache = run.spark.createDataFrame([], "key string, vector array<float>")
    encoded = run.keep(vectors.encoded(made, cache, run.dimension), "embed", "chunks")
    run.keep(encoded.groupBy("key").agg(F.first("embedding").alias("vector")), "embed", "cache")


def link(run: Run) -> None:
    config, java, pages, sql = (run.table("extract", n) for n in ("config", "java", "pages", "sql"))
    mapped = config.select(F.explode(F.arrays_zip("mapping_names", "mapping_urls")).alias("m")).select(paths.route_id(F.lit(None).cast("string"), F.col("m.mapping_urls")).alias("id"), F.col("m.mapping_urls").alias("path"), F.col("m.mapping_names").alias("name"))
    struts = config.select(F.explode(F.arrays_zip("paths", "types")).alias("m")).select(paths.route_id(F.lit(None).cast("string"), paths.normalize_action(F.col("m.paths"))).alias("id"), F.col("m.paths").alias("path"), F.col("m.types").alias("name")).where("path IS NOT NULL")
    rest = java.where(F.size("rest_paths") > 0).select(F.explode("rest_paths").alias("p"), F.get("types", F.lit(0)).alias("name"), F.coalesce(F.get("verbs", F.lit(0)), F.lit("GET")).alias("verb")).select(paths.rest_route_id(F.col("p"), F.col("verb")).alias("id"), F.col("p").alias("path"), "name")
    routes = run.keep(mapped.unionByName(struts).unionByName(rest).groupBy("id").agg(F.max("path").alias("path"), F.max("name").alias("name")), "link", "routes")

    classes = java.where(F.size("types") > 0).select(F.get("types", F.lit(0)).alias("name"), F.concat_ws(".", F.nullif("package", F.lit("")), F.get("types", F.lit(0))).alias("fqn"), F.col("path").alias("ord"), F.concat(F.lit("class_"), F.get("types", F.lit(0))).alias("class_id"))
    index = linking.class_index(classes)
    handles = routes.join(index, "name").select(F.col("id").alias("from_id"), F.col("class_id").alias("to_id"), F.lit("handlesRoute").alias("type"), F.lit(0.9).alias("confidence"))
    inline = java.select(F.concat(F.lit("class_"), F.get("types", F.lit(0))).alias("from_id"), F.explode("sql").alias("s")).select("from_id", linking.edge_type(text.statement_class(F.col("s"))).alias("type"), F.explode(text.table_names(F.col("s"))).alias("t")).select("from_id", F.concat(F.lit("table_"), F.lower("t")).alias("to_id"), "type", F.lit(0.85).alias("confidence"))
    in_files = sql.where("class IN ('SELECT', 'INSERT', 'UPDATE', 'DELETE')").select(F.concat(F.lit("file_"), F.md5("path")).alias("from_id"), linking.edge_type(F.col("class")).alias("type"), F.explode("tables").alias("t")).select("from_id", F.concat(F.lit("table_"), F.lower("t")).alias("to_id"), "type", F.lit(0.9).alias("confidence"))
    secured = java.select(F.concat(F.lit("class_"), F.get("types", F.lit(0))).alias("from_id"), F.explode("roles").alias("r")).select("from_id", F.concat(F.lit("role_"), text.canonical_role(F.col("r"))).alias("to_id"), F.lit("securedBy").alias("type"), F.lit(0.9).alias("confidence"))
    edge = lambda column, kind, confidence: pages.select(paths.page_id(F.col("path")).alias("from_id"), F.explode(column).alias("t")).where(F.col("t").rlike("(?i)[.]jspf?(?:[?#]|$)")).select("from_id", paths.page_id(paths.clean_target(F.col("t"))).alias("to_id"), F.lit(kind).alias("type"), F.lit(confidence).alias("confidence"))
    page_edges = edge("includes", "includesView", 0.9).unionByName(edge("iframes", "embedsView", 0.85)).unionByName(edge("redirects", "redirectsTo", 0.8))
    page_roles = pages.select(paths.page_id(F.col("path")).alias("from_id"), F.explode("roles").alias("r")).select("from_id", F.concat(F.lit("role_"), text.canonical_role(F.col("r"))).alias("to_id"), F.lit("securedBy").alias("type"), F.lit(0.9).alias("confidence"))
    #: Of equal relations the first family's stays, as the families come one after the other; within one the surest.
    every = handles.withColumn("ord", F.lit(0))
    for k, part in enumerate((inline, in_files, secured, page_edges, page_roles), 1):
        every = every.unionByName(part.withColumn("ord", F.lit(k)))
    every = every.where("from_id IS NOT NULL AND to_id IS NOT NULL").withColumn("id", linking.relation_id(F.col("from_id"), F.col("type"), F.col("to_id")))
    relations = run.keep(linking.deduplicated(every, ["id"], F.struct("ord", -F.col("confidence"), "from_id", "to_id")).drop("ord"), "link", "relations")
    ids = relations.select(F.explode(F.array("from_id", "to_id")).alias("id")).unionByName(routes.select("id")).distinct()
    run.keep(ids.select("id", F.substring_index("id", "_", 1).alias("type")), "link", "entities")
    handled = relations.where("type = 'handlesRoute'").select(F.col("from_id").alias("route"), F.col("to_id").alias("from_id"))
    run.keep(graph.crud_summary(handled.join(relations, "from_id"), "route"), "link", "traces")
    run.keep(graph.gated(relations, run.least_confidence), "link", "kept")


def assembled(run: Run) -> None:
    routes, kept = run.table("link", "routes"), run.table("link", "kept")
    handled = kept.where("type = 'handlesRoute'").select(F.col("from_id").alias("route"), F.col("to_id").alias("from_id"))
    own = handled.join(kept, "from_id").select(F.col("route").alias("from_id"), "to_id", "type", "confidence")
    #: Domains of a single route join the first that shares tables or roles with them.
    run.keep(assemble.capabilities(routes, own.unionByName(kept.where("type = 'handlesRoute'").select(own.columns)), merge=True), "assemble", "capabilities")


def rendered(run: Run) -> None:
    caps = run.table("assemble", "capabilities")
    none = lambda kind: F.lit(None).cast(kind)
    told = F.concat(F.lit("Covers "), "members", F.lit(" routes"))
    parts = run.keep(render.bundle(caps.select("id", "name", told.alias("purpose"), none("string").alias("menu"), "domain", none("string").alias("subdomain"), none("string").alias("layer"), "screens", "handlers", "tables", F.array().cast("array<string>").alias("procedures"), "citations", none("string").alias("rationale")), run.name), "render", "sections")
    run.keep(render.bundle_texts(parts), "render", "documents")


BUILD: dict[str, Callable[[Run], None]] = dict(zip(STAGES, (scan, extracted, embed, link, assembled, rendered)))


def execute(run: Run, first: str = STAGES[0], last: str = STAGES[-1]) -> Run:
    """Run the stages from first to last; earlier ones must have been run."""
    for stage in STAGES[STAGES.index(first) : STAGES.index(last) + 1]:
        BUILD[stage](run)
        for _, after, plugin in run.plugins:
            if after == stage:
                plugin(run)
    return run


def measures(run: Run) -> DataFrame:
    """Gate rows of a finished run."""
    files, java = run.table("scan", "files"), run.table("extract", "java")
    chunks, caps = run.table("embed", "chunks"), run.table("assemble", "capabilities")
    one = lambda df, c, name: df.agg(c.alias(name))
    m = one(java, gates.ratio(F.count_if(F.size("types") > 0), F.count("*")), "parse_success").crossJoin(one(chunks, gates.ratio(F.count("embedding"), F.count("*")), "embedding_coverage"))
    covered = assemble.coverage_share(caps, run.table("link", "routes")).select(F.col("share").alias("capability_coverage"))
    return gates.gate_rows(m.crossJoin(covered).crossJoin(one(files, F.count("*"), "n_files")))
