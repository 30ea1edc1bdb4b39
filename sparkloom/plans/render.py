"""Markdown documents out of capability rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions.text import humanize, markdown_head, markdown_row, nz


def domain_sections(df: DataFrame, group: str, title: str, cells: list[str], order: list[str]) -> DataFrame:
    """One section a group: a heading and a table whose rows are in order. Groups are report-sized."""
    rows = df.select(F.coalesce(F.col(group), F.lit("Unclassified")).alias("section"), F.struct(*order, markdown_row(*(F.col(c) for c in cells)).alias("line")).alias("row"))
    made = rows.groupBy("section").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return made.select("section", F.concat(F.lit("## "), "section", F.lit("\n\n" + markdown_head([title, *cells][-len(cells):]) + "\n"), F.array_join(F.transform("rows", lambda r: r["line"]), "\n")).alias("body"))


def document(sections: DataFrame, title: str) -> DataFrame:
    """One row: the sections in order under a title."""
    return sections.agg(F.concat(F.lit(f"# {title}\n\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section", "body"))), lambda s: s["body"]), "\n\n")).alias("markdown"))


#: What stands between the parts of a document.
BETWEEN = "\n\n"


def named(list_: Column) -> Column:
    """The distinct names of a list, sorted, or a dash."""
    names = F.array_sort(F.array_distinct(F.filter(F.transform(list_, lambda x: nz(x)), lambda x: x.isNotNull())))
    return F.coalesce(F.nullif(F.array_join(names, ", "), F.lit("")), F.lit("-"))


def business_row(name: Column, purpose: Column, menu: Column) -> Column:
    """Name (or the purpose's beginning, for names of two letters) with its menu, and the purpose."""
    own = F.coalesce(humanize(name), F.lit(""))
    told = F.coalesce(purpose, F.lit(""))
    short = F.concat(F.substring(told, 1, 60), F.when(F.length(told) > 60, "…").otherwise(""))
    shown = F.when(F.length(own) <= 2, short).otherwise(own)
    return markdown_row(F.when(nz(menu).isNotNull(), F.concat(shown, F.lit(" (Menu: "), nz(menu), F.lit(")"))).otherwise(shown), F.trim(told))


def bundle(caps: DataFrame, project: str) -> DataFrame:
    """The parts of the two documents, with where they stand: document (brd, tech), ord, domain, subdomain, layer, title,
    summary, capabilities (id, name), body, start, end. A part's text is [start, end) of its document.

    caps: id, name, purpose, menu, domain, subdomain, layer, screens, handlers, tables, procedures (arrays), citations,
    rationale. Domains that are null or blank are Unclassified; capabilities are in the order of their ids."""
    c = caps.withColumn("domain", F.coalesce(F.nullif(F.trim("domain"), F.lit("")), F.lit("Unclassified"))).withColumns({k: nz(F.col(k)) for k in ("subdomain", "layer")})
    rationale = F.when(nz(F.col("rationale")).isNotNull(), F.concat(F.lit(" — Rationale: "), nz(F.col("rationale")))).otherwise("")
    line = F.struct(
        "id",
        "name",
        business_row(F.coalesce(nz(F.col("name")), F.col("id")), F.col("purpose"), F.col("menu")).alias("business"),
        markdown_row(F.col("name"), *(named(F.col(k)) for k in ("screens", "handlers", "tables", "procedures"))).alias("technical"),
        F.concat(F.lit("- "), "name", F.lit(" — Evidence: "), F.coalesce("citations", F.lit(0)).cast("string"), F.lit(" citations"), rationale).alias("detail"),
    )
    rows = c.select("domain", "subdomain", "layer", line.alias("line"))
    text = lambda k: F.array_join(F.transform("lines", lambda x: x[k]), "\n")
    count = F.concat(F.size("lines").cast("string"), F.lit(" capabilities"))
    listed = F.transform("lines", lambda x: F.struct(x["id"].alias("id"), x["name"].alias("name")))
    gathered = F.array_sort(F.collect_list("line")).alias("lines")
    brd = rows.groupBy("domain").agg(gathered).select(F.lit("brd").alias("document"), F.lit(3).alias("part"), "domain", F.lit(None).cast("string").alias("subdomain"), F.lit(None).cast("string").alias("layer"), F.col("domain").alias("title"), count.alias("summary"), listed.alias("capabilities"), F.concat(F.lit("### "), "domain", F.lit(BETWEEN + markdown_head(["Capability", "Business Purpose"]) + "\n"), text("business")).alias("body"))
    bits = lambda gap: F.concat("domain", F.coalesce(F.concat(F.lit(gap), "subdomain"), F.lit("")), F.coalesce(F.concat(F.lit(" — "), "layer"), F.lit("")))
    details = F.array_join(F.transform("lines", lambda x: x["detail"]), BETWEEN)
    tech = rows.groupBy("domain", "subdomain", "layer").agg(gathered).select(F.lit("tech").alias("document"), F.lit(3).alias("part"), "domain", "subdomain", "layer", bits(" / ").alias("title"), count.alias("summary"), listed.alias("capabilities"), F.concat(F.lit("### "), bits("/ "), F.lit(BETWEEN + markdown_head(["Capability", "Screens", "Handlers", "Tables", "Procedures"]) + "\n"), text("technical"), F.lit(BETWEEN), details).alias("body"))
    sections = brd.unionByName(tech)
    spark = caps.sparkSession
    fixed = spark.createDataFrame(
        [
            ("brd", 0, f"# {project} — Business Requirements Document"),
            ("brd", 1, "Business-focused view of capabilities grouped by domain."),
            ("tech", 0, f"# {project} — Technical Specification"),
            ("tech", 1, "Generated from the capability graph with citations and provenance."),
        ],
        "document string, part int, body string",
    )
    #: One line a domain.
    domains = brd.agg(F.array_sort(F.collect_list(F.struct("domain", "summary"))).alias("d")).where("size(d) > 0").select(F.lit("brd").alias("document"), F.lit(2).alias("part"), F.concat(F.lit("## Domains" + BETWEEN), F.array_join(F.transform("d", lambda x: F.concat(F.lit("- "), x["domain"], F.lit(": "), x["summary"])), "\n")).alias("body"))
    parts = sections.unionByName(fixed.unionByName(domains), allowMissingColumns=True)
    #: Sections are one a domain; their lengths add up to where the next one begins.
    order = Window.partitionBy("document").orderBy("part", "domain", F.coalesce("subdomain", F.lit("")), F.coalesce("layer", F.lit("")))
    before = F.coalesce(F.sum(F.length("body") + len(BETWEEN)).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    placed = parts.select("*", F.row_number().over(order).alias("ord"), before.alias("start"))
    return placed.select("document", "ord", "domain", "subdomain", "layer", "title", "summary", "capabilities", "body", "start", (F.col("start") + F.length("body")).alias("end"))


def bundle_texts(parts: DataFrame) -> DataFrame:
    """document, markdown: the parts of each document in order."""
    return parts.groupBy("document").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "body"))), lambda p: p["body"]), BETWEEN).alias("markdown"))
