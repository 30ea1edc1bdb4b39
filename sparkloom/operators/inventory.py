"""The inventory query: an immutable builder over a files table.

Each call returns a new query; filters are Columns that Catalyst pushes to the scan.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KNOWN_LAYERS = ("UI", "Service", "Database", "Integration", "Utility", "Configuration", "Reporting", "Other")


@dataclass(frozen=True)
class Query:
    """files: path, language, source_location, size_bytes, layer, type, functional_name, framework_hints, ..."""

    df: DataFrame
    sets: tuple[tuple[str, tuple[str, ...]], ...] = ()
    tests: tuple[Column, ...] = ()

    def _and(self, test: Column) -> Query:
        return replace(self, tests=(*self.tests, test))

    def _in(self, name: str, values: tuple[str, ...]) -> Query:
        """Values of one set add up across calls."""
        known = dict(self.sets)
        return replace(self, sets=tuple((known | {name: (*known.get(name, ()), *values)}).items()))

    def path_contains(self, text: str) -> Query:
        return self._and(F.contains("path", F.lit(text)))

    def path_regex(self, pattern: str) -> Query:
        """Unanchored; an invalid pattern yields no rows."""
        try:
            re.compile(pattern)
        except re.error:
            return self._and(F.lit(False))
        return self._and(F.col("path").rlike(pattern))

    def path_startswith(self, text: str) -> Query:
        return self._and(F.startswith("path", F.lit(text)))

    def path_endswith(self, text: str) -> Query:
        return self._and(F.endswith("path", F.lit(text)))

    def language(self, *names: str) -> Query:
        return self._in("language", names)

    def file_type(self, *names: str) -> Query:
        return self._in("type", names)

    def subdomain_type(self, *names: str) -> Query:
        """Null passes."""
        return self._and(F.col("subdomain_type").isNull() | F.col("subdomain_type").isin(*names))

    def layer(self, *names: str) -> Query:
        """A missing or unknown layer passes only where Other is asked for."""
        return self._and(F.when(F.col("layer").isin(*KNOWN_LAYERS), F.col("layer").isin(*names)).otherwise(F.lit("Other" in names)))

    def architectural_layer(self, *names: str) -> Query:
        return self._in("architectural_layer", names)

    def detail_type(self, *names: str) -> Query:
        return self._in("details_type", names)

    def framework_hint(self, *names: str) -> Query:
        return self._and(F.arrays_overlap("framework_hints", F.array(*map(F.lit, names))))

    def has_framework_hints(self, has: bool = True) -> Query:
        return self._and((F.size("framework_hints") > 0) == F.lit(has))

    def min_size(self, n: int) -> Query:
        return self._and(F.col("size_bytes") >= n) if n else self

    def max_size(self, n: int) -> Query:
        return self._and(F.col("size_bytes") <= n) if n else self

    def functional_name_contains(self, text: str) -> Query:
        return self._and(F.contains("functional_name", F.lit(text)))

    def min_confidence(self, x: float) -> Query:
        return self._and(F.col("confidence") >= x)

    def max_confidence(self, x: float) -> Query:
        return self._and(F.col("confidence") <= x)

    def has_nested(self, array: str, test: Callable[[Column], Column], has: bool = True) -> Query:
        """EXISTS over a nested array, as for entity mappings or SQL executions."""
        return self._and(F.coalesce(F.exists(array, test), F.lit(False)) == F.lit(has))

    def where(self, test: Column) -> Query:
        return self._and(test)

    def execute(self) -> DataFrame:
        tests = [*self.tests, *(F.col(name).isin(*values) for name, values in self.sets)]
        return self.df.where(reduce(lambda a, b: a & b, tests)) if tests else self.df

    def count(self) -> DataFrame:
        return self.execute().agg(F.count("*").alias("n"))

    def exists(self) -> bool:
        return not self.execute().isEmpty()

    def first(self, *order: str) -> DataFrame:
        return self.execute().orderBy(*order).limit(1)

    def count_by(self, *keys: str) -> DataFrame:
        return self.execute().groupBy(*keys).agg(F.count("*").alias("n"))

    def group_by(self, key: str, value: str = "path") -> DataFrame:
        """Members as one sorted text; groups larger than memory are for count_by."""
        return self.execute().groupBy(key).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list(value)), ",").alias("members"))


def files(df: DataFrame) -> Query:
    return Query(df)


def large_files(df: DataFrame, least: int = 50_000) -> DataFrame:
    return files(df).min_size(least).execute()


def by_language(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.lower("language") == name.lower())


def by_path(df: DataFrame, path: str) -> DataFrame:
    return df.where(F.col("path") == path).limit(1)


def by_glob(df: DataFrame, pattern: str) -> DataFrame:
    from sparkloom.functions.paths import matches_glob

    return df.where(matches_glob(F.col("path"), pattern))


def in_scope(df: DataFrame, languages: list[str], include: list[str], exclude: list[str]) -> DataFrame:
    from sparkloom.functions.paths import matches_glob

    any_of = lambda globs: reduce(lambda a, b: a | b, (matches_glob(F.col("path"), g) for g in globs), F.lit(False))
    kept = F.col("language").isin(*languages)
    return df.where(kept & (any_of(include) if include else F.lit(True)) & ~any_of(exclude))


def mappings_of(groups: DataFrame, kind: str) -> DataFrame:
    """groups: group_name, mappings array of structs with mapping_type."""
    return groups.select("group_name", F.explode("mappings").alias("m")).select("group_name", "m.*").where(F.col("mapping_type") == kind)


def lookup(df: DataFrame, **keys: str) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, (F.col(k) == v for k, v in keys.items())))
