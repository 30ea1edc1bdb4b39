"""Files of a project tree as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions.checks import decoded, encoding_of
from sparkloom.functions.classify import file_type, framework_hints, is_build_file, language_of
from sparkloom.functions.paths import excluded, expand_braces, extension, filename, matches_glob, stem

SKIPPED = [".git", "target", "node_modules", "bin"]


def listed(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """path, modificationTime, length, content: contents are read only where they are used."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)


def inventory(spark: SparkSession, root: str, extensions: list[str] | None = None, most_mb: int = 10, skip: list[str] = SKIPPED) -> DataFrame:
    """The files table of a tree. Size and name filters work on the listing, before any content."""
    base = root.rstrip("/") + "/"
    df = listed(spark, root).withColumn("relative", F.substr("path", F.instr("path", base) + len(base)))
    ext = extension(F.col("relative"))
    df = df.where((F.col("length") <= most_mb * 1_000_000) & ~excluded(F.col("relative"), skip))
    df = df.where(ext.isin(*extensions)) if extensions else df
    text = decoded(F.col("content"), encoding_of(F.col("content")))
    return df.select(
        F.col("relative").alias("path"),
        language_of(ext).alias("language"),
        file_type(ext).alias("type"),
        F.col("length").alias("size_bytes"),
        F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss").alias("last_modified"),
        stem(F.col("relative")).alias("functional_name"),
        F.when(F.contains("relative", F.lit("/")), F.substring_index("relative", "/", 1)).otherwise(F.lit(".")).alias("source_location"),
        is_build_file(filename(F.col("relative"))).alias("is_build_file"),
        text.alias("text"),
    ).withColumn("framework_hints", framework_hints(F.col("text")))


def roots(df: DataFrame, indicators: dict[str, list[str]], least: int = 1) -> DataFrame:
    """Source roots: the part of a path up to its first functional directory, with enough files of the language."""
    names = F.array(*(F.lit(d) for dirs in indicators.values() for d in dirs))
    parts = F.split("path", "/")
    at = F.array_min(F.filter(F.transform(names, lambda d: F.array_position(parts, d)), lambda p: p > 0))
    own = df.withColumn("root", F.array_join(F.slice(parts, F.lit(1), at.cast("int")), "/")).where("root IS NOT NULL")
    return own.groupBy("root").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("language")).alias("languages")).where(F.col("n") >= least)


def grep(df: DataFrame, pattern: str, text: str = "text") -> DataFrame:
    """Files with matches and how many."""
    return df.select("path", F.regexp_count(text, F.lit(pattern)).alias("n")).where("n > 0")


def grep_lines(df: DataFrame, pattern: str, text: str = "text", most: int = 20) -> DataFrame:
    """The first matching lines of all: path, line, content. The cap is the report's."""
    rows = df.select("path", F.posexplode(F.split(text, "\n")).alias("at", "content")).where(F.col("content").rlike(pattern))
    return rows.select("path", (F.col("at") + 1).alias("line"), "content").orderBy("path", "line").limit(most)


def glob_sample(df: DataFrame, glob: str, k: int = 10) -> tuple[DataFrame, DataFrame]:
    test = F.lit(False)
    for g in expand_braces(glob):
        test = test | matches_glob(F.col("path"), g)
    own = df.where(test)
    return own.agg(F.count("*").alias("n")), own.select("path").orderBy("path").limit(k)


def preview(df: DataFrame, most: int = 20_000, text: str = "text") -> DataFrame:
    return df.select("path", F.substring(text, 1, most).alias("preview"), (F.length(text) > most).alias("cut"))


def json_documents(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def config(path: str, env: dict[str, str]) -> dict:
    """YAML with ${NAME:default}; small, read on the driver."""
    import re

    import yaml

    with open(path, encoding="utf-8") as file:
        return yaml.safe_load(re.sub(r"\$\{(\w+)(?::([^}]*))?\}", lambda m: env.get(m[1], m[2] or ""), file.read())) or {}
