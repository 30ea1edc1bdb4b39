"""Rows of nested documents: YAML and JSON as VARIANT values, walked level by level until nothing is left."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.operators.graph import checkpointed

#: Names of values that hold a path (fixed values).
PATH_NAMES = ("path", "file_path", "directory")


@F.arrow_udf(T.StringType())
def yaml_as_json(texts: pa.Array) -> pa.Array:
    """A YAML document as JSON; null where it is none. Keys become text, times and the like too.

    The library's parser in C reads it where there is one; what that one refuses is read by the one in Python."""
    import yaml

    def one(text, loaders=tuple(dict.fromkeys((getattr(yaml, "CSafeLoader", yaml.SafeLoader), yaml.SafeLoader)))):
        for loader in loaders if text is not None else ():
            try:
                return json.dumps(yaml.load(text, loader), default=str, ensure_ascii=False)
            except (yaml.YAMLError, ValueError, TypeError, RecursionError):
                continue
        return None

    return pa.array([one(t.as_py()) for t in texts], pa.string())


def walked(df: DataFrame, id_col: str, document: Column) -> DataFrame:
    """One row a value: id, path (`a.b[0]`), name, depth (the document itself is 0), kind (object, array, string, number,
    boolean, null), value (of scalars, as text), children. document: JSON text.

    One step a level: objects and arrays are exploded until no level has any. What is not JSON has no rows."""
    level = df.select(F.col(id_col).alias("__id"), F.lit("").alias("path"), F.lit("").alias("name"), F.lit(0).alias("depth"), F.try_parse_json(document).alias("v")).where("v IS NOT NULL")
    found = None
    while True:
        kind = F.schema_of_variant("v")
        kind = F.when(F.startswith(kind, F.lit("OBJECT")), "object").when(F.startswith(kind, F.lit("ARRAY")), "array").when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind.isin("VOID", "NULL"), "null").otherwise("number")
        #: Each level is written once to the shared folder.
        rows = checkpointed(level.withColumn("kind", kind))
        found = rows if found is None else found.unionByName(rows)
        inner = rows.where("kind IN ('object', 'array')")
        if inner.isEmpty():
            break
        exploded = inner.alias("t").lateralJoin(df.sparkSession.tvf.variant_explode(F.col("t.v").outer()).alias("x"))
        step = F.when(F.col("t.kind") == "array", F.concat(F.col("t.path"), F.lit("["), F.col("x.pos").cast("string"), F.lit("]"))).when(F.col("t.path") == "", F.col("x.key")).otherwise(F.concat("t.path", F.lit("."), "x.key"))
        level = exploded.select(F.col("t.__id").alias("__id"), step.alias("path"), F.coalesce(F.col("x.key"), F.col("t.name")).alias("name"), (F.col("t.depth") + 1).alias("depth"), F.col("x.value").alias("v"))
    scalar = ~F.col("kind").isin("object", "array", "null")
    return found.select(F.col("__id").alias(id_col), "path", "name", "depth", "kind", F.when(scalar, F.col("v").cast("string")).alias("value"))


def depths(rows: DataFrame, id_col: str) -> DataFrame:
    """The depth of each document: the deepest value, empty objects and arrays counted at their own place."""
    return rows.groupBy(id_col).agg(F.max("depth").alias("max_depth"))


def path_violations(rows: DataFrame, id_col: str) -> DataFrame:
    """Values named as paths that are absolute or have backslashes: id, path, value, violation (one row each)."""
    named = rows.where(F.col("name").isin(*PATH_NAMES) & (F.col("kind") == "string"))
    tests = F.array_compact(F.array(F.when(F.contains("value", F.lit("\\")), F.lit("windows")), F.when(F.startswith("value", F.lit("/")), F.lit("absolute"))))
    return named.select(id_col, "path", "value", F.explode(tests).alias("violation"))
