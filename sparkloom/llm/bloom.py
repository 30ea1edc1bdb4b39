"""A blocked Bloom filter made of DataFrame operations only, and what is built on it.

The filter is a table (block, w0..w7: 512 bits a block), sized by the number of its
keys up to BLOCKS blocks: 1,048,576 blocks of 72 bytes are 75 MB, the bound of its
broadcast. That is 16 bits a key for CAPACITY keys; a fuller filter only passes more
rows, and every user follows it with an exact step.

The caller's rows travel as one struct, so that no column of theirs, whatever its
name, meets a column of the filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from sparkloom.llm.common import staged, with_group

BLOCKS, LEAST = 1 << 20, 1 << 10
WORDS, BITS = 8, 16
CAPACITY = BLOCKS * 64 * WORDS // BITS


def carried(df: DataFrame) -> Column:
    """All columns of df as one struct."""
    return F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in df.columns)).alias("__row")


def blocks_for(keys: int) -> int:
    """A power of two that gives each key BITS bits, within the bounds."""
    return min(BLOCKS, max(LEAST, 1 << (max(1, keys) * BITS // (64 * WORDS)).bit_length()))


def _block(h: Column, blocks: int) -> Column:
    """Never null, or Catalyst would test it for null in a filter that computes the key anew."""
    return h.bitwiseAND(F.lit(blocks - 1)).cast("int")


def _bit(h: str, i: int) -> str:
    return f"cast(pmod(shiftrightunsigned(xxhash64({h}, 7), {6 * i}), 64) as int)"


def build(keys: DataFrame, blocks: int) -> DataFrame:
    """keys: one bigint column of key hashes. Pre-aggregated before its shuffle."""
    k = keys.select(F.col(keys.columns[0]).alias("__k")).where("__k IS NOT NULL")
    return k.groupBy(_block(F.col("__k"), blocks).alias("__block")).agg(*(F.bit_or(F.expr(f"shiftleft(1L, {_bit('__k', i)})")).alias(f"__w{i}") for i in range(WORDS)))


def tested(df: DataFrame, h: str, bits: DataFrame, blocks: int, hit: str) -> DataFrame:
    """df (columns of our own making) with a boolean: the key hash in column h may be in the filter."""
    both = F.lit(True)
    for i in range(WORDS):
        both &= F.expr(f"(shiftrightunsigned(__w{i}, {_bit(h, i)}) & 1) = 1")
    own = df.columns
    marked = df.withColumn("__block", _block(F.col(h), blocks)).join(F.broadcast(bits), "__block", "left")
    return marked.select(*own, F.coalesce(both, F.lit(False)).alias(hit))


def passing(df: DataFrame, h: Column, bits: DataFrame, blocks: int) -> DataFrame:
    """Rows of df whose key hash may be in the filter (no row of a listed key is lost)."""
    rows = df.select(carried(df), h.alias("__h"))
    return tested(rows, "__h", bits, blocks, "__hit").where("__hit").select("__row.*")


def _orderable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_orderable(f.dataType) for f in kind)
    return not isinstance(kind, (MapType, VariantType))


def digest(id_col: str, text_col: str) -> tuple[Column, Column]:
    """Two 64-bit hashes that know a row by its id and its whole text."""
    i, t = F.col(id_col), F.col(text_col)
    flags = i.isNull().cast("int") + F.lit(2) * t.isNull().cast("int")
    return F.xxhash64(flags, i, t), F.xxhash64(t, F.lit(1), i, flags)


def kept(docs: DataFrame, a: Column, b: Column, decided: DataFrame, reach: tuple[Column, DataFrame, int] | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The rows of docs that stay, with all their columns.

    a, b: the digest of a row. decided, a staged table: __a, __b, __n (rows of this digest),
    __stays; one row a digest. Of rows that stay and have one digest, the one with the least
    hash of its columns is taken. reach: a key hash with its filter; rows that the filter
    clears stay, and decided need not hold them. Where it is None, decided holds every row.

    Two filters decide: the first holds the digests that go, the second those that stay and
    yet hit the first. A row that misses the first stays, one that hits the first alone goes,
    and only rows that hit both (some thousandths) meet the decisions in a join. So texts
    are not shuffled, but beyond CAPACITY digests that go (one shuffle of the rows then).
    """
    n_gone, n_twice = decided.agg(F.count_if(F.expr("NOT __stays OR __n > 1")), F.count_if(F.expr("__stays AND __n > 1"))).first()
    rows = docs.select(carried(docs), a.alias("__a"), b.alias("__b"))
    if reach is not None:
        rows = tested(docs.select(carried(docs), a.alias("__a"), b.alias("__b"), reach[0].alias("__h")), "__h", reach[1], reach[2], "__reached")
    else:
        rows = rows.withColumn("__reached", F.lit(True))
    if not n_gone:
        return docs
    gone = decided.where("NOT __stays OR __n > 1")
    keys = ["__a", "__b"]
    clear = []
    if n_gone <= capacity:
        blocks = blocks_for(n_gone)
        first = staged(build(gone.select("__a"), blocks), "filter")
        rows = tested(rows, "__a", first, blocks, "__hit").withColumn("__hit", F.expr("__reached AND __hit"))
        clear.append(rows.where("NOT __hit"))
        both = staged(tested(decided.where("__stays AND __n = 1").select(*keys), "__a", first, blocks, "__hit").where("__hit").select(*keys), "hit-and-stay")
        n_both = both.count()
        if n_both:
            blocks = blocks_for(n_both)
            second = staged(build(both.select("__b"), blocks), "filter")
            doubtful = tested(rows.where("__hit"), "__b", second, blocks, "__again").where("__again")
            clear.append(doubtful.join(both, keys, "left_semi"))
        doubtful = rows.where("__hit")
    else:
        clear.append(rows.where("NOT __reached"))
        doubtful = rows.where("__reached")
        clear.append(doubtful.join(gone, keys, "left_anti"))
    found = clear[0].select("__row")
    for part in clear[1:]:
        found = found.unionByName(part.select("__row"))
    if n_twice:
        #: Repeated rows: one of each digest. They meet within their partitions first.
        twice = decided.where("__stays AND __n > 1").select(*keys)
        blocks = blocks_for(n_twice)
        only = tested(doubtful, "__b", staged(build(twice.select("__b"), blocks), "filter"), blocks, "__again").where("__again")
        plain = [f"__row.`{f.name.replace('`', '``')}`" for f in docs.schema if _orderable(f.dataType)]
        one = only.groupBy(*keys).agg(F.min_by("__row", F.xxhash64(*plain)).alias("__row")).join(twice, keys, "left_semi")
        found = found.unionByName(one.select("__row"))
    return found.select("__row.*")


def decisions(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row a digest for kept(). rows: __a, __b, __id and the keys of their group, a staged
    table. Of a group stays the least id that is not null, then the least digest."""
    digests = staged(rows.groupBy(*keys, "__a", "__b").agg(F.count("*").alias("__n"), F.min("__id").alias("__id")), "digests")
    order = F.struct(F.col("__id").isNull().alias("none"), "__id", "__a", "__b")
    best = digests.groupBy(*keys).agg(F.min(order).alias("__best"), F.count("*").alias("__size")).select(*keys, "__size", F.col("__best.__a").alias("__best_a"), F.col("__best.__b").alias("__best_b"))
    met = with_group(digests, staged(best, "best"), keys, "__size")
    return met.select("__a", "__b", "__n", F.expr("__a = __best_a AND __b = __best_b").alias("__stays"))
