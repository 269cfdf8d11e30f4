"""Lifecycles: an entity's events against an automaton of legal steps.

An illegal event is marked and leaves the state as it was, so whether a
later one is legal depends on all before it.  As a function of the state it
starts with, a stretch of events is a table with one entry per state;
``folds`` splits a hot entity into stretches and puts their tables together.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.operators.folds import fold_scan


class Automaton:
    """States 0 (before the first event) to n; an event's value is the state
    it leads to, -1 for one that no state allows."""

    first = 0

    def __init__(self, n: int, legal: frozenset[tuple[int, int]]) -> None:
        self.n, self.legal = n, legal

    def step(self, state: int, value: int) -> tuple[bool, int]:
        ok = (state, value) in self.legal
        return ok, value if ok else state

    def nothing(self) -> list[int]:
        return list(range(self.n + 1))

    def then(self, function: list[int], value: int) -> list[int]:
        return [self.step(s, value)[1] for s in function]

    def pack(self, function: list[int]) -> list[int]:
        return function

    def after(self, packed: list[int], state: int) -> int:
        return packed[state]


def walk(events: DataFrame, key: str, order: Sequence[str], status: str, legal: Sequence[tuple[str | None, str]],
         num_partitions: int | None = None) -> DataFrame:
    """The rows of ``events`` with ``is_legal`` and ``state`` (the status after
    the row; NULL while no event was legal).  ``legal`` holds (from, to)
    pairs, from None for a first event.  A NULL status is never legal."""
    names = sorted({x for pair in legal for x in pair if x is not None})
    number = {None: 0, **{s: i + 1 for i, s in enumerate(names)}}
    machine = Automaton(len(names), frozenset((number[a], number[b]) for a, b in legal))
    value: Column = F.lit(-1)
    for s in names:
        value = F.when(F.col(status) == s, number[s]).otherwise(value)
    value = F.coalesce(value, F.lit(-1))
    done = fold_scan(events, key, order, value, machine, num_partitions)
    state = F.element_at(F.array(F.lit(None).cast("string"), *[F.lit(s) for s in names]), (F.col("state") + 1).cast("int"))
    return done.select("row.*", F.col("accepted").alias("is_legal"), state.alias("state"))


def summary(walked: DataFrame, key: str, order: Sequence[str], event_id: str) -> DataFrame:
    """Per entity: ``n_events``, ``n_illegal``, ``first_illegal`` (the id of its
    first illegal event), ``final_state``."""
    at = F.struct(*[F.col(c) for c in order])
    return walked.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if(~F.col("is_legal")).alias("n_illegal"),
        F.min_by(F.when(~F.col("is_legal"), F.col(event_id)), F.when(~F.col("is_legal"), at)).alias("first_illegal"),
        F.max_by("state", at).alias("final_state"))
