"""How filters interact: what each removes in every order, and its fair share.

A document is told by the set of filters it fails, so a part of the corpus is
told by 32 counts. The removal game gives a coalition of filters the documents
that at least one of them fails. Its Hart-Mas-Colell potential follows from the
coalitions with one filter less,

    P(S) = (v(S) + sum of P(S without i) over i in S) / |S|,

and the Shapley value of a filter is the potential of all filters minus the
potential without it. What a filter removes as a step of an order is the
difference of two coalitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlake.llm.common import WORD, stored

FILTERS = "ABCDE"
COALITIONS = 1 << len(FILTERS)
ORDERS = factorial(len(FILTERS))
# Parts worked out at once.
AT_ONCE = 200

LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
ODD_CHARACTERS = r"[#$%&*|]"


def failed_filters(text: Column) -> Column:
    """Bits 0 to 3: too few words, repeated words, capitals, odd characters. NULL text is empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    conditions = (
        n < LEAST_WORDS,
        100 * distinct.cast("bigint") < LEAST_DISTINCT * n.cast("bigint"),
        100 * F.regexp_count(text, F.lit("[A-Z]")).cast("bigint") > MOST_CAPITALS * F.char_length(text).cast("bigint"),
        text.rlike(ODD_CHARACTERS),
    )
    bits = F.lit(0)
    for i, condition in enumerate(conditions):
        bits = bits + F.when(condition, 1 << i).otherwise(0)
    return bits


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, failed (a bit per filter), good, toxic: one row per document.

    The last bit is set for a text that a smaller doc_id has, too.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = stored(
        docs.select(
            "doc_id",
            F.coalesce("source", F.lit("")).alias("part"),
            failed_filters(F.col("text")).alias("failed"),
            F.sha2(text, 256).alias("digest"),
        ),
        "failures",
    )
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    # Only texts that occur again are joined; of a large group of copies one row comes back.
    again = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return (
        rows.join(again.drop("n"), "digest", "left")
        .select("doc_id", "part", (F.col("failed") + F.when(copy, 1 << 4).otherwise(0)).alias("failed"))
        .join(marks, "doc_id", "left")
        .select("part", "failed", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")))
    )


def coalition_values(counts: np.ndarray) -> np.ndarray:
    """v(S) for every coalition S, from counts by the set of failed filters (last axis)."""
    sets = np.arange(COALITIONS)
    return counts @ ((sets[:, None] & sets[None, :]) != 0).astype(np.int64)


def potentials(values: np.ndarray) -> np.ndarray:
    """Potentials times the number of orders, which makes them whole numbers."""
    found = np.zeros_like(values)
    for coalition in range(1, COALITIONS):
        members = [i for i in range(len(FILTERS)) if coalition >> i & 1]
        without = sum(found[..., coalition & ~(1 << i)] for i in members)
        found[..., coalition] = (ORDERS * values[..., coalition] + without) // len(members)
    return found


def _steps() -> pd.DataFrame:
    """Every step of every order: the filter and the coalitions before and after it."""
    rows = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, i in enumerate(order, 1):
            rows.append(("".join(FILTERS[j] for j in order), step, i, before, before | 1 << i))
            before |= 1 << i
    return pd.DataFrame(rows, columns=["filter_order", "step", "filter", "before", "after"])


def _audited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    steps = _steps()
    i, before, after = (steps[c].to_numpy() for c in ("filter", "before", "after"))
    everyone = COALITIONS - 1
    for batch in batches:
        for at in range(0, len(batch), AT_ONCE):
            some = batch.iloc[at : at + AT_ONCE]
            counts = {c: np.stack(some[c].tolist()).astype(np.int64) for c in ("n", "good", "toxic")}
            total = counts["n"].sum(axis=1, keepdims=True)
            removal, good, toxic = (coalition_values(counts[c]) for c in ("n", "good", "toxic"))
            potential = potentials(removal)
            removed = removal[:, after] - removal[:, before]
            columns = {
                "kept": total - removal[:, after],
                "removed": removed,
                "redundant": removal[:, 1 << i] - removed,
                "unique_fails": removal[:, [everyone]] - removal[:, everyone & ~(1 << i)],
                "good_lost": good[:, after] - good[:, before],
                "toxic_lost": toxic[:, after] - toxic[:, before],
                "shapley": potential[:, [everyone]] - potential[:, everyone & ~(1 << i)],
            }
            yield pd.DataFrame(
                {
                    "part": np.repeat(some["part"].to_numpy(dtype=object), len(steps)),
                    "filter_order": np.tile(steps["filter_order"].to_numpy(dtype=object), len(some)),
                    "step": np.tile(steps["step"].to_numpy(np.int32), len(some)),
                    **{name: values.ravel() for name, values in columns.items()},
                }
            )


def interaction_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    One row per part (source; NULL counts as the empty string), order and step,
    zeros included. `shapley` is the Shapley value times the 120 orders. NULL
    texts are empty. A row without a doc_id has no label and isn't taken for a
    copy, nor does it make others copies; rows that repeat a doc_id aren't
    copies of each other, since neither is smaller. A document is good or toxic
    if any of its label rows says so. Without documents there are no rows.
    """
    # The sets of failed filters bound what a part sends on, however many documents it has.
    sets = failures(docs, labels).groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )
    cells = [
        F.array(*(F.coalesce(F.max(F.when(F.col("failed") == s, F.col(c))), F.lit(0)) for s in range(COALITIONS))).alias(c)
        for c in ("n", "good", "toxic")
    ]
    schema = (
        "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
        "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
    )
    return sets.groupBy("part").agg(*cells).mapInPandas(_audited, schema)
