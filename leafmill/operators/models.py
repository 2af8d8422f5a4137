"""Models behind one interface: only rows that no cached answer has reach them, in batches, in the workers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Model(Protocol):
    """A text model: answers to prompts, None where it has none."""

    name: str

    def answer(self, prompts: list[str]) -> list[str | None]: ...


class Offline:
    """No model: every answer is null, so that each stage takes its deterministic way."""

    name = "offline"

    def answer(self, prompts: list[str]) -> list[str | None]:
        return [None] * len(prompts)


def answered(requests: DataFrame, cache: DataFrame | None, make: Callable[[], Model], size: int = 64) -> DataFrame:
    """(key, answer, cached) of requests (key, prompt), each key once.

    `make` runs once in every task that has misses.  Answers of the cache (key, answer) are joined first, so prompts that it
    holds never leave the JVM.  Write the rows with cached = false to the cache."""
    once = requests.groupBy("key").agg(F.min("prompt").alias("prompt"))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model: Model | None = None
        for batch in batches:
            for i in range(0, len(batch), size):
                part = batch.iloc[i : i + size]
                model = model or make()
                yield pd.DataFrame({"key": part["key"], "answer": model.answer(part["prompt"].tolist()), "cached": False})

    if cache is None:
        return once.mapInPandas(ask, "key string, answer string, cached boolean")
    known = cache.select("key", "answer").dropDuplicates(["key"])
    misses = once.join(known.select("key"), "key", "left_anti").mapInPandas(ask, "key string, answer string, cached boolean")
    hits = once.select("key").join(known, "key").withColumn("cached", F.lit(True))
    return hits.unionByName(misses)
