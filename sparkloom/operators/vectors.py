"""Vectors: normalising, similarity, search, clusters.

Search takes a stated set of queries against all rows, in blocks: the rows stay in
their partitions, each block of queries visits them, and partial top-k lists meet in
one aggregation, so what moves is queries x partitions x k scores.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST = 20  # neighbours that a search gives at most
#: Vectors of a block, and picked pairs whose scores are summed at once.
BLOCK, SCORED = 2048, 1 << 15


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def normalized(v: Column) -> Column:
    """Zero vectors stay as they are."""
    n = norm(v)
    return F.transform(v, lambda x: F.when(n == 0, x).otherwise(x / n))


def cosine(a: Column, b: Column) -> Column:
    n = norm(a) * norm(b)
    return F.when(n == 0, 0.0).otherwise(dot(a, b) / n)


def with_dimension(v: Column, d: int) -> Column:
    return F.slice(F.concat(v, F.array_repeat(F.lit(0.0), d)), 1, d)


def text_hash(text: Column) -> Column:
    return F.sha1(text.cast("binary"))


def indexed(df: DataFrame, id_col: str, vector: str, d: int) -> DataFrame:
    """Rows with a vector of the right size, normalised."""
    return df.where(F.col(vector).isNotNull() & (F.size(vector) == d)).withColumn(vector, normalized(doubles(F.col(vector))))


def _blocks(df: DataFrame, id_col: str, vector: str, names: tuple[str, str], n: int) -> DataFrame:
    """__b and the ids and vectors of each of n blocks, as two arrays."""
    own = df.where(F.col(vector).isNotNull()).select(F.pmod(F.xxhash64(id_col), F.lit(n)).cast("int").alias("__b"), F.struct(F.col(id_col).alias("id"), doubles(F.col(vector)).alias("v")).alias("x"))
    rows = own.groupBy("__b").agg(F.collect_list("x").alias("x"))
    return rows.select("__b", F.col("x.id").alias(names[0]), F.col("x.v").alias(names[1]))


def pairs_of_blocks(queries: DataFrame, rows: DataFrame, pick, id_col: str, vector: str, block: int = BLOCK) -> DataFrame:
    """query_id, neighbor_id, score: what pick chooses of each block of queries against each block of rows.

    A block has about `block` vectors; each block of rows is copied once a block of queries and meets it by an
    equi-join, so no pair of vectors becomes a row but those picked. pick(scores, ids) gives the places of
    a matrix of scores that are kept. Scores are then summed again in order, one product after the other."""
    n_q, n_r = (max(1, -(-df.count() // block)) for df in (queries, rows))
    q = _blocks(queries, id_col, vector, ("q_ids", "q_vectors"), n_q)
    r = _blocks(rows, id_col, vector, ("r_ids", "r_vectors"), n_r)
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                ids = [batch.column(c)[k].values for c in (0, 2)]
                a, b = (np.asarray(batch.column(c)[k].values.flatten()).reshape(len(i), -1) for c, i in zip((1, 3), ids))
                i, j = pick(a @ b.T, np.asarray(ids[1]))
                for at in range(0, len(i), SCORED):
                    x, y = i[at : at + SCORED], j[at : at + SCORED]
                    score = np.add.accumulate(a[x] * b[y], axis=1)[:, -1] if a.shape[1] else np.zeros(len(x))
                    yield pa.RecordBatch.from_arrays([ids[0].take(pa.array(x)), ids[1].take(pa.array(y)), pa.array(score)], names=["query_id", "neighbor_id", "score"])

    copies = r.select(F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("__b"), "r_ids", "r_vectors")
    joined = q.join(copies, "__b").select("q_ids", "q_vectors", "r_ids", "r_vectors")
    found = joined.repartition(min(n_q * n_r, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))).mapInArrow(run, f"query_id {kind}, neighbor_id {kind}, score double")
    return found.withColumn("score", F.round("score", 6))


def best_of_block(k: int):
    """The k best of each query by rounded score, of equal scores the least ids; the value below too, for what rounding may move."""

    def pick(scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(ids, kind="stable")
        micro = np.rint(scores[:, order] * 1e6)
        if micro.shape[1] > k:
            least = -np.partition(-micro, k - 1, axis=1)[:, k - 1 : k]
            #: Above the k-th value there are fewer than k; of it and the next below, the first k by id.
            keep = micro > least
            for value in (least, least - 1):
                tied = micro == value
                keep |= tied & (np.cumsum(tied, axis=1) <= k)
        else:
            keep = np.ones(micro.shape, bool)
        i, j = np.nonzero(keep)
        return i, order[j]

    return pick


def knn(queries: DataFrame, rows: DataFrame, k: int, least: float = -1.0, id_col: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """query_id, neighbor_id, score, rank. k is capped at MOST; the query itself counts among
    the k and is then removed, so at most k - 1 neighbours come back. Both sides normalised.

    Each block of rows gives its k best a query; these partial lists meet in one ranking."""
    k = min(k, MOST)
    scored = pairs_of_blocks(queries, rows, best_of_block(k), id_col, vector, block)
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "neighbor_id"))).where(F.col("rank") <= k)
    return ranked.where((F.col("query_id") != F.col("neighbor_id")) & (F.col("score") >= least))


def similar(queries: DataFrame, rows: DataFrame, least: float, id_col: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """query_id, neighbor_id, score of all pairs at or above a score, a vector with itself left out. Both sides normalised."""
    found = pairs_of_blocks(queries, rows, lambda scores, _: np.nonzero(scores >= least - 1e-6), id_col, vector, block)
    return found.where((F.col("score") >= least) & (F.col("query_id") != F.col("neighbor_id")))


def boosts(neighbours: DataFrame, full: float = 0.05) -> DataFrame:
    from sparkloom.functions.scoring import confidence_boost

    own = neighbours.groupBy("query_id").agg(F.count("*").alias("n"), F.round(F.avg("score"), 6).alias("mean"))
    return own.withColumn("boost", confidence_boost(F.col("mean"), F.col("n"), full))


def cluster_ranges(df: DataFrame, id_col: str, n: int, least: int) -> DataFrame:
    """Contiguous index ranges of equal size, the remainder left out (compat); ids are 0, 1, ..."""
    total = df.agg(F.count("*").alias("total"), F.min(id_col).alias("low"))
    size = F.greatest(F.lit(least), F.floor(F.col("total") / n)).cast("long")
    at = F.floor((F.col(id_col) - F.col("low")) / size).cast("long")
    return df.crossJoin(F.broadcast(total)).select(id_col, at.alias("cluster")).where(F.col("cluster") < n)


def cluster_count(rows: int, least: int = 3) -> int:
    return min(10, max(3, rows // 20, 1), max(1, rows // max(1, least)))


def kmeans(df: DataFrame, vector: str, k: int, seed: int = 7) -> DataFrame:
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    ready = df.withColumn("__f", array_to_vector(doubles(F.col(vector))))
    model = KMeans(k=k, seed=seed, featuresCol="__f", predictionCol="cluster").fit(ready)
    return model.transform(ready).drop("__f")


def approximate(df: DataFrame, vector: str, radius: float = 2.0, tables: int = 4, seed: int = 7):
    """A fitted LSH model, for searches where exactness may give way to size."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    ready = df.withColumn("features", array_to_vector(doubles(F.col(vector))))
    return BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=radius, numHashTables=tables, seed=seed).fit(ready), ready


def placeholder(d: int):
    """Texts to seeded unit vectors, for runs without a model."""

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import numpy as np

        for texts in batches:
            out = []
            for t in texts:
                r = np.random.default_rng(int(hashlib.sha1((t or "").encode()).hexdigest()[:16], 16)).uniform(-1, 1, d)
                out.append((r / np.linalg.norm(r)).astype(np.float32))
            yield pd.Series(out)

    return encode


def encoded(chunks: DataFrame, cache: DataFrame, d: int, text: str = "content") -> DataFrame:
    """Vectors from the cache by content hash; misses are encoded once per distinct text."""
    keyed = chunks.withColumn("key", text_hash(F.col(text)))
    known = cache.select("key", F.col("vector").alias("embedding"))
    misses = keyed.join(known, "key", "left_anti").groupBy("key").agg(F.min(text).alias(text)).select("key", placeholder(d)(F.col(text)).alias("embedding"))
    return keyed.join(known.unionByName(misses), "key", "left")
