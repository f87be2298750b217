"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees on random parts of a bounded labelled sample propose rules: the
conjunctions of conditions along their paths. A logistic regression with lasso
penalty weighs them and drops most. What is left is compiled into one Spark
column expression over the statistics, so scoring needs no model at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlake.llm.common import id_and_text, with_number_id
from courierlake.llm.labelled import logistic_fit, sampled, training_labels

# The classifier is fitted on at most so many labelled rows.
SAMPLE_ROWS = 10_000
TREES, DEPTH, LEAF_ROWS, CUTS = 40, 3, 15, 16
PENALTIES = (0.004, 0.002, 0.001, 0.0005)

STATISTICS = (
    "bytes",
    "words",
    "lines",
    "mean_word",
    "longest_word",
    "distinct_words",
    "commonest_word",
    "repeated_next",
    "distinct_lines",
    "upper",
    "digits",
    "symbols",
    "pipes",
    "marks",
    "stops",
    "non_ascii",
    "blank",
    "upper_words",
    "symbol_ends",
    "short_words",
    "control",
)


def _class(chars: bytes) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(chars)] = True
    return mask


_UPPER, _LOWER = _class(bytes(range(65, 91))), _class(bytes(range(97, 123)))
_DIGIT, _BLANK = _class(b"0123456789"), _class(b" \t\n\r\x0b\x0c")
_STOP, _MARK, _PIPE = _class(b".,"), _class(b"!?"), _class(b"|")
_CONTROL = _class(bytes(set(range(32)) - set(b"\t\n\r\x0b\x0c")) + b"\x7f")
_HIGH = np.arange(256) >= 128
_SYMBOL = ~(_UPPER | _LOWER | _DIGIT | _BLANK | _STOP | _MARK | _PIPE | _CONTROL | _HIGH)
_SYMBOL_BYTES = frozenset(np.flatnonzero(_SYMBOL | _MARK).tolist())


def statistics_of(text: str | None) -> tuple[float, ...]:
    """The statistics of one text, in the order of `STATISTICS`; NULL counts as empty."""
    data = b"" if text is None else text.encode("utf-8", "replace")
    size = max(len(data), 1)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    n = max(len(words), 1)
    different: dict[bytes, int] = {}
    for w in words:
        different[w] = different.get(w, 0) + 1
    lines = [x for x in data.split(b"\n") if x.strip()]
    letters = max(int(counts[_UPPER].sum() + counts[_LOWER].sum()), 1)
    lengths = [len(w) for w in words]
    return (
        float(len(data)),
        float(len(words)),
        float(len(lines)),
        sum(lengths) / n,
        float(max(lengths, default=0)),
        len(different) / n,
        max(different.values(), default=0) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        len(set(lines)) / max(len(lines), 1),
        counts[_UPPER].sum() / letters,
        counts[_DIGIT].sum() / size,
        counts[_SYMBOL].sum() / size,
        counts[_PIPE].sum() / size,
        counts[_MARK].sum() / size,
        counts[_STOP].sum() / size,
        counts[_HIGH].sum() / size,
        counts[_BLANK].sum() / size,
        sum(map(bytes.isupper, words)) / n,
        sum(w[-1] in _SYMBOL_BYTES for w in words) / n,
        sum(x <= 3 for x in lengths) / n,
        counts[_CONTROL].sum() / size,
    )


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every whole text."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame([statistics_of(t) for t in batch["text"]], columns=list(STATISTICS), dtype=float)
            found.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield found

    schema = "doc_id string, " + ", ".join(f"{s} double" for s in STATISTICS)
    return with_number_id(id_and_text(docs).mapInPandas(measure, schema))


@dataclass(frozen=True)
class Rule:
    """Conditions (statistic, is above, limit), all of which hold."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        tests = [F.col(s) > F.lit(x) if above else F.col(s) <= F.lit(x) for s, above, x in self.conditions]
        return reduce(lambda a, b: a & b, tests)

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        tests = [values[s] > x if above else values[s] <= x for s, above, x in self.conditions]
        return np.logical_and.reduce(tests)


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; `score` is one column expression over the statistics."""

    rules: tuple[tuple[Rule, float], ...]
    bias: float

    def score(self) -> Column:
        total = F.lit(float(self.bias))
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), F.lit(float(weight))).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def _grow(x: np.ndarray, y: np.ndarray, rows: np.ndarray, depth: int, rng, path: tuple, found: set) -> None:
    """Split by the largest gain in squared error, over a random third of the statistics."""
    if depth == 0 or len(rows) < 2 * LEAF_ROWS or y[rows].min() == y[rows].max():
        return
    best = None
    for j in rng.choice(x.shape[1], max(2, x.shape[1] // 3), replace=False):
        values = x[rows, j]
        for cut in np.unique(np.quantile(values, np.linspace(0.02, 0.98, CUTS))):
            left = values <= cut
            a, b = int(left.sum()), int((~left).sum())
            if a < LEAF_ROWS or b < LEAF_ROWS:
                continue
            gain = (y[rows[left]].mean() - y[rows[~left]].mean()) ** 2 * a * b
            if best is None or gain > best[0]:
                best = (gain, j, float(cut), left)
    if best is None:
        return
    _, j, cut, left = best
    for part, above in ((rows[left], False), (rows[~left], True)):
        longer = (*path, (STATISTICS[j], above, cut))
        found.add(Rule(longer))
        _grow(x, y, part, depth - 1, rng, longer, found)


def fit_rules(sample: pd.DataFrame, seed: int = 7) -> RuleModel:
    """Rules and weights from labelled statistics (`label` and `STATISTICS`).

    Without rows every text scores 1; with one class only, its share. The
    penalty is the strongest whose loss on a quarter of the sample is within
    2 percent of the best.
    """
    y = sample["label"].to_numpy(float)
    if len(y) == 0 or y.min() == y.max():
        share = 1.0 if len(y) == 0 else (y.sum() + 1) / (len(y) + 2)
        return RuleModel((), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    x = sample[list(STATISTICS)].to_numpy(float)
    rng = np.random.default_rng(seed)
    test = rng.random(len(y)) < 0.25
    found: set[Rule] = set()
    inside = np.flatnonzero(~test)
    weights = np.where(y[inside] > 0.5, 0.5 / max(y[inside].sum(), 1), 0.5 / max((1 - y[inside]).sum(), 1))
    for _ in range(TREES):
        # Half of each class, so that the rare one is seen by every tree.
        part = rng.choice(inside, min(len(inside), 2000), replace=True, p=weights / weights.sum())
        _grow(x, y, part, DEPTH, rng, (), found)
    rules = sorted(found, key=lambda r: r.conditions)
    values = {s: x[:, i] for i, s in enumerate(STATISTICS)}
    matrix = np.stack([r.holds(values) for r in rules], axis=1).astype(np.float32) if rules else np.zeros((len(y), 0))
    # One rule of those that hold for the same rows is enough.
    first = sorted({row.tobytes(): i for i, row in reversed(list(enumerate(matrix.T)))}.values())
    rules, matrix = [rules[i] for i in first], matrix[:, first]
    losses = []
    for penalty in PENALTIES:
        w = logistic_fit(matrix[~test], y[~test], l1=penalty)
        p = 1 / (1 + np.exp(-np.clip(matrix[test] @ w[:-1] + w[-1], -30, 30)))
        losses.append(-np.mean(np.log(np.where(y[test] > 0.5, p, 1 - p) + 1e-12)) if test.any() else 0.0)
    chosen = next(p for p, loss in zip(PENALTIES, losses) if loss <= 1.02 * min(losses) + 1e-9)
    w = logistic_fit(matrix, y, l1=chosen, steps=400)
    kept = tuple((r, float(v)) for r, v in zip(rules, w[:-1]) if abs(v) > 1e-6)
    return RuleModel(kept, float(w[-1]))


def fit(docs: DataFrame, labels: DataFrame, label: str, at_most: int = SAMPLE_ROWS) -> RuleModel:
    """Fit on at most `at_most` labelled rows outside the held-out fold."""
    train = sampled(training_labels(labels, label), at_most, seed=5)
    rows = text_statistics(docs.join(F.broadcast(train.select("doc_id")), "doc_id", "left_semi"))
    return fit_rules(rows.join(F.broadcast(train), "doc_id").toPandas().sort_values(["doc_id", *STATISTICS]))


def with_score(docs: DataFrame, model: RuleModel, name: str) -> DataFrame:
    """All columns of `docs` (with `text`) and the score of each row as `name`."""

    @F.pandas_udf(", ".join(f"{s} double" for s in STATISTICS))
    def measure(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics_of(t) for t in texts], columns=list(STATISTICS), dtype=float)

    given = docs.select(F.struct("*").alias("_given"), measure("text").alias("_stats"))
    scored = given.select("_given", "_stats.*").select("_given", model.score().alias("_score"))
    return scored.select(*(F.col("_given")[c].alias(c) for c in docs.columns), F.col("_score").alias(name))


def quality_scores(docs: DataFrame, labels: DataFrame, at_most: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id and `score` (0 to 1) of every row of `docs`.

    NULL and empty texts are scored by their statistics, which are all 0;
    repeated rows score alike; the columns of `docs` other than doc_id and
    text are not looked at.
    """
    model = fit(docs, labels, "quality", at_most)
    return text_statistics(docs).select("doc_id", model.score().alias("score"))
