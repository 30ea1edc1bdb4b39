"""Extension points: classifiers, plug-ins and stage hooks as plain functions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Classifier = Callable[[DataFrame], Column]


@dataclass
class Chain:
    """Classifiers in order; the first that gives a value wins, the fallback comes last."""

    fallback: Classifier
    own: list[tuple[str, Classifier]] = field(default_factory=list)

    def register(self, name: str, build: Classifier) -> Chain:
        return Chain(self.fallback, [*self.own, (name, build)])

    def apply(self, df: DataFrame, into: str) -> DataFrame:
        return df.withColumn(into, F.coalesce(*(build(df) for _, build in self.own), self.fallback(df)))


@dataclass
class Stage:
    """prepare reads, build plans, publish writes after the gates held; publish validates once."""

    name: str
    prepare: Callable[..., dict[str, DataFrame]]
    build: Callable[[dict[str, DataFrame]], dict[str, DataFrame]]
    gates: Callable[[dict[str, DataFrame]], DataFrame] | None = None

    def run(self, publish: Callable[[str, str, DataFrame], None], *args) -> dict[str, DataFrame]:
        from sparkloom.operators.gates import enforced

        made = self.build(self.prepare(*args))
        if self.gates is not None:
            enforced(self.gates(made))
        for name, df in made.items():
            publish(self.name, name, df)
        return made


def with_plugins(df: DataFrame, plugins: list[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    for plugin in plugins:
        df = df.transform(plugin)
    return df
