"""Prompts and model answers. Models are injected; without one the heuristic answers."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.text import first_json


def formatted(template: str, values: dict[str, Column]) -> Column:
    """{name} replaced; a name without a value is an error."""
    if missing := set(re.findall(r"\{(\w+)\}", template)) - values.keys():
        raise KeyError(f"no value for {sorted(missing)}")
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def bounded(head: Column, snippets: Column, most: int = 4000) -> Column:
    """Five snippets of 800 letters; if too long three of 300; then cut."""
    part = lambda n, size: F.concat_ws("\n", head, F.array_join(F.transform(F.slice(snippets, 1, n), lambda s: F.substring(s, 1, size)), "\n"))
    return F.substring(F.when(F.length(part(5, 800)) <= most, part(5, 800)).otherwise(part(3, 300)), 1, most)


def prompt_hash(prompt: Column) -> Column:
    return F.sha1(prompt.cast("binary"))


def parsed(answer: Column) -> Column:
    """The answer where it is an object, else the first object in it, else null."""
    whole = F.when(F.json_object_keys(answer).isNotNull(), answer)
    return F.coalesce(whole, first_json(answer))


def validated(answer: Column, keys: list[str]) -> Column:
    ok = F.lit(True)
    for k in keys:
        ok = ok & (F.trim(F.coalesce(F.get_json_object(answer, f"$.{k}"), F.lit(""))) != "")
    return F.when(ok, answer)


def answered(df: DataFrame, prompt: str, heuristic: Column, model: Callable[[DataFrame, str], DataFrame] | None = None, strategy: str = "heuristic_first") -> DataFrame:
    """Adds `answer`. model adds `model_answer` to the rows it is given; it is asked only where it counts."""
    if model is None:
        return df.withColumn("answer", heuristic)
    if strategy == "heuristic_first":
        known = df.withColumn("answer", heuristic)
        asked = model(known.where("answer IS NULL").drop("answer"), prompt).withColumnRenamed("model_answer", "answer")
        return known.where("answer IS NOT NULL").unionByName(asked)
    own = model(df, prompt)
    return own.withColumn("answer", F.col("model_answer") if strategy == "always_llm" else F.coalesce("model_answer", heuristic)).drop("model_answer")
