"""Reports: small tables about the graph and the inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.paths import business_domain


def segments(df: DataFrame, path: Column) -> DataFrame:
    """Counts by first, and by first two path segments: level, key, n."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    keys = F.array(F.struct(F.lit(1).alias("level"), F.get(parts, F.lit(0)).alias("key")), F.struct(F.lit(2).alias("level"), F.when(F.size(parts) > 1, F.array_join(F.slice(parts, 1, 2), "/")).alias("key")))
    return df.select(F.explode(keys).alias("k")).select("k.*").where("key IS NOT NULL").groupBy("level", "key").agg(F.count("*").alias("n"))


def by_domain(df: DataFrame, path: Column) -> DataFrame:
    return df.groupBy(business_domain(path).alias("domain")).agg(F.count("*").alias("n"))


def categorized(df: DataFrame, rules: list[tuple[str, Column]], default: str = "other") -> DataFrame:
    """Counts and percent by the first rule that holds."""
    kind = F.coalesce(*(F.when(test, F.lit(name)) for name, test in rules), F.lit(default))
    found = df.groupBy(kind.alias("category")).agg(F.count("*").alias("n"))
    return found.crossJoin(F.broadcast(found.agg(F.sum("n").alias("total")))).select("category", "n", F.round(100 * F.col("n") / F.col("total"), 2).alias("percent"))


def suffixes(df: DataFrame, name: Column, pattern: str = r"([A-Z][a-z]+)$") -> DataFrame:
    return df.select(F.regexp_extract(name, pattern, 1).alias("suffix")).where("suffix != ''").groupBy("suffix").agg(F.count("*").alias("n"))


def attribute_keys(entities: DataFrame, attributes: str = "attributes") -> DataFrame:
    return entities.select(F.explode(F.map_keys(attributes)).alias("key")).groupBy("key").agg(F.count("*").alias("n"))


def endpoints(relations: DataFrame, entities: DataFrame) -> DataFrame:
    """Each relation with the types of both ends; entities are joined by key."""
    e = entities.select("id", "type")
    a, b = (e.select(F.col("id").alias(f"{s}_id"), F.col("type").alias(f"{s}_type")) for s in ("from", "to"))
    return relations.join(a, "from_id").join(b, "to_id").groupBy("from_type", "type", "to_type").agg(F.count("*").alias("n"))


def frequent(df: DataFrame, name: str, least: int = 2, longer: int = 2) -> DataFrame:
    return df.where(F.length(name) > longer).groupBy(name).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def distinct_values(df: DataFrame, key: str, most: int = 200) -> DataFrame:
    """Sorted distinct values of a field or of an array's items; the cap is the report's."""
    kind = df.schema[key].dataType.typeName()
    rows = df.select(F.explode_outer(key).alias("value")) if kind == "array" else df.select(F.col(key).alias("value"))
    return rows.distinct().orderBy("value").limit(most)


def recommendations(measures: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """One row a rule that holds for the one row of measures."""
    return measures.select(F.explode(F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in rules)))).alias("recommendation"))


def text_report(sections: list[tuple[str, DataFrame]]) -> DataFrame:
    """One line a row of each report-sized section, under its title: section, at, line."""
    out = None
    for i, (title, df) in enumerate(sections):
        body = df.select(F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in df.columns)).alias("line"))
        part = body.select(F.lit(i).alias("section"), F.lit(1).alias("at"), "line").unionByName(df.sparkSession.createDataFrame([(i, 0, title)], "section int, at int, line string"))
        out = part if out is None else out.unionByName(part)
    return out
