"""Exact dedup by progressive refinement: length, prefix hash, full hash.

Each level looks only at what the level before could not tell apart: lengths that
occur once end the matter for a text, then prefix hashes within a length; the whole
content is hashed only of what is left. Levels shuffle pre-aggregated counts, never a
text; the keys that go on to the next level reach the scan as a Bloom filter.

Defined results: a null text counts as empty; runs of white space count as one
space. Of equal texts the smallest doc_id stays (null ids last). In exact_dedup, rows
that repeat both id and text share one decision, as they share the id; kept_documents
decides by row and keeps one of them. An empty table gives an empty result. Other
columns of the input are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import bloom
from sparkloom.llm.common import staged, table, text_of, with_group

PREFIX = 256
KEYS = ["__len", "__p", "__sha"]
#: Single spaces stay as they are, so that the pattern matches rarely.
RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_of(column), RUNS, " ")


def keyed(docs: DataFrame, id_col: str, text_col: str, prefix: int) -> DataFrame:
    """__id, __a, __b (the row's digest), __t (the normalised text), __len (its length in bytes), __p (prefix hash)."""
    a, b = bloom.digest(id_col, text_col)
    t = docs.select(F.col(id_col).alias("__id"), a.alias("__a"), b.alias("__b"), normalised(text_col).alias("__t"))
    return t.select("*", F.octet_length("__t").alias("__len"), F.xxhash64(F.substring("__t", 1, prefix)).alias("__p"))


def repeated(keys: DataFrame, label: str) -> tuple[DataFrame, int]:
    """The filter of the keys that occur more than once, and its size."""
    names = keys.columns
    found = staged(keys.groupBy(*names).agg(F.count("*").alias("__c")).where("__c > 1").select(F.xxhash64(*names).alias("__k")), label)
    blocks = bloom.blocks_for(found.count())
    return staged(bloom.build(found, blocks), f"{label}-filter"), blocks


def survivors(docs: DataFrame, id_col: str, text_col: str, prefix: int) -> tuple[DataFrame, tuple[DataFrame, int]]:
    """The rows of keyed() whose length and prefix hash occur more than once, and the filter that says so."""
    rows = keyed(docs, id_col, text_col, prefix)
    lengths = repeated(rows.select("__len"), "dedup-lengths")
    prefixes = repeated(bloom.passing(rows.select("__len", "__p"), F.xxhash64("__len"), *lengths), "dedup-prefixes")
    return bloom.passing(rows, F.xxhash64("__len", "__p"), *prefixes), prefixes


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Only narrow rows are shuffled; those of large groups meet a broadcast."""
    left, _ = survivors(docs, id_col, text_col, prefix)
    found = left.groupBy("__len", "__p", F.sha2("__t", 256).alias("__sha")).agg(F.min("__id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1")
    rows = keyed(docs, id_col, text_col, prefix).select("__id", "__len", "__p", F.sha2("__t", 256).alias("__sha"))
    keep = F.when(F.col("group_size").isNull(), F.col("__id")).otherwise(F.col("keep_id"))
    return with_group(rows, staged(found, "dedup-groups"), KEYS, "group_size").select(
        F.col("__id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("__id").eqNullSafe(keep).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX) -> DataFrame:
    """The rows that stay, one of each group of equal texts, with all their columns. Texts are not shuffled."""
    left, prefixes = survivors(docs, id_col, text_col, prefix)
    rows = staged(left.select("__id", "__a", "__b", "__len", "__p", F.sha2("__t", 256).alias("__sha")), "dedup-survivors")
    decided = staged(bloom.decisions(rows, KEYS), "dedup-decisions")
    a, b = bloom.digest(id_col, text_col)
    length_and_prefix = F.xxhash64(F.octet_length(normalised(text_col)), F.xxhash64(F.substring(normalised(text_col), 1, prefix)))
    return bloom.kept(docs, a, b, decided, (length_and_prefix, *prefixes))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = {
    "op1_exact_dedup": r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""
}
