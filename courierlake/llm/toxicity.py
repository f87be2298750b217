"""Toxic passages as maximum-scoring segments of token log-odds.

Words get the log-odds of toxic against other documents, with Dirichlet
priors: a word leans on the odds of its first five letters, those on the first
four, those on all words, so unseen forms of a toxic stem score too. A scan in
linear time finds all maximal segments of positive sum. Segment scores follow
an extreme-value law under clean text, so a segment counts by how far it lies
beyond what a clean text of that length reaches by chance, and a document by
all of its significant segments.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.llm.common import fold_bytes, id_and_text, stored, with_number_id
from courierlake.llm.labelled import logistic_fit, sampled, training_labels

# Word odds come from at most so many labelled rows; the ids and labels of
# these rows are broadcast, and what their texts hold bounds the odds table.
SAMPLE_ROWS = 40_000
# Pseudo-counts of the level below, and least standard score of a kept token.
PRIOR, LEAST_Z = 3.0, 3.0
# What every word costs, so that clean text drifts down, and the most one word adds.
DRIFT, MOST_SCORE = 0.3, 4.0
# A segment is significant if at most so many as good are expected by chance.
SIGNIFICANT = 0.05

_LETTERS = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def tokens_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters (any byte beyond ASCII counts as a letter)."""
    return _LETTERS.findall(fold_bytes(text))


def levels_of(token: bytes) -> tuple[bytes, ...]:
    """The token itself and its stems, marked by their length."""
    return (b"=" + token, b"5" + token[:5], b"4" + token[:4])


@dataclass
class OddsModel:
    """Scores of tokens and the extreme-value law of clean text."""

    odds: dict[bytes, float]
    lam: float = 1.0
    log_k: float = 0.0
    weights: tuple[float, float] = (1.0, -3.0)
    cache: dict[bytes, float] = field(default_factory=dict, repr=False)

    def token_score(self, token: bytes) -> float:
        """Log-odds of the most specific known level, less the drift."""
        known = self.cache.get(token)
        if known is None:
            known = -DRIFT
            for level in levels_of(token):
                if level in self.odds:
                    known += self.odds[level]
                    break
            if len(self.cache) < 300_000:
                self.cache[token] = known
        return known

    def significant(self, segments: list[tuple[int, int, float]], tokens: int) -> list[tuple[int, int, float]]:
        """The segments of which few are expected by chance, in order of place."""
        limit = -math.log(SIGNIFICANT)
        return sorted(s for s in segments if self.excess(s[2], tokens) >= limit)

    def excess(self, score: float, tokens: int) -> float:
        """Minus the log of the number of segments as good expected by chance."""
        return self.lam * score - self.log_k - math.log(max(tokens, 1))

    def evidence(self, found: list[tuple[int, int, float]], tokens: int) -> float:
        """Sum of the excesses of the significant segments, on a log scale."""
        return math.log1p(sum(max(self.excess(s, tokens), 0.0) for _, _, s in found))

    def probability(self, evidence: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(min(self.weights[0] * evidence + self.weights[1], 30.0), -30.0)))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score) in time linear in the scores.

    Only positive scores are visited. Each candidate knows the sums before and
    after it and the nearest earlier candidate with a smaller sum before it.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple[float, float, int, int, int]] = []  # before, after, first, end, earlier
    for i in np.flatnonzero(scores > 0).tolist():
        before, after, first, end = float(sums[i]), float(sums[i + 1]), i, i + 1
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= before:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= after:
                stack.append((before, after, first, end, j))
                break
            before, first = stack[j][0], stack[j][2]
            del stack[j:]
    return [(first, end, after - before) for before, after, first, end, _ in stack]


def token_counts(rows: DataFrame) -> DataFrame:
    """level, toxic, other: how many toxic and how many other documents of `rows`
    (label, text) hold a token level. Each task sends its sums."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[bytes, list[int]] = {}
            for label, text in zip(batch["label"], batch["text"]):
                for level in {x for t in set(tokens_of(text)) for x in levels_of(t)}:
                    found.setdefault(level, [0, 0])[1 - label] += 1
            yield pd.DataFrame(
                {
                    "level": list(found),
                    "toxic": [c[0] for c in found.values()],
                    "other": [c[1] for c in found.values()],
                }
            )

    counted = rows.select("label", "text").mapInPandas(count, "level binary, toxic bigint, other bigint")
    return counted.groupBy("level").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def context_counts(rows: DataFrame, telling: set[bytes]) -> pd.DataFrame:
    """How many different contexts the telling levels have in toxic and in other documents.

    The context of a level is the words around its first occurrence in a
    document. Copies of one text share it, so a group of copies counts once
    and its rare words don't pass for toxic ones. One row per telling level
    reaches the driver.
    """
    shared = rows.sparkSession.sparkContext.broadcast(telling)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = shared.value
        for batch in batches:
            found: set[tuple] = set()
            for label, text in zip(batch["label"], batch["text"]):
                tokens, done = tokens_of(text), set()
                for i, token in enumerate(tokens):
                    for level in levels_of(token):
                        if level in wanted and level not in done:
                            done.add(level)
                            around = b" ".join(tokens[max(i - 1, 0) : i] + [b""] + tokens[i + 1 : i + 2])
                            found.add((level, label, xxhash.xxh3_64_intdigest(around) >> 1))
            yield pd.DataFrame(list(found), columns=["level", "label", "context"])

    found = rows.select("label", "text").mapInPandas(find, "level binary, label int, context bigint").distinct()
    toxic = F.sum("label").alias("toxic")
    return found.groupBy("level").agg(toxic, F.sum(1 - F.col("label")).alias("other")).toPandas()


def token_odds(counts: pd.DataFrame, toxic: int, other: int) -> dict[bytes, float]:
    """Log-odds per level with the prior of the level below, capped.

    A level is kept where its odds differ from those of all documents by
    `LEAST_Z` standard errors.
    """
    base = (toxic + 0.5) / (toxic + other + 1.0)
    base_odds = math.log(base / (1 - base))
    table = {bytes(r.level): (r.toxic, r.other) for r in counts.itertuples()}

    def rate(level: bytes, below: float) -> tuple[float, float]:
        t, o = table.get(level, (0, 0))
        return (t + PRIOR * below) / (t + o + PRIOR), t + o

    odds: dict[bytes, float] = {}
    for level in table:
        stem = level[1:]
        q, n = rate(b"4" + stem[:4], base)
        if level[:1] in (b"5", b"="):
            q, n = rate(b"5" + stem[:5], q)
        if level[:1] == b"=":
            q, n = rate(level, q)
        value = math.log(q / (1 - q)) - base_odds
        error = math.sqrt(1 / ((n + PRIOR) * q * (1 - q)))
        if abs(value) >= LEAST_Z * error:
            odds[level] = max(min(value, MOST_SCORE), -MOST_SCORE)
    return odds


def solve_lambda(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of sum of weight x exp(lambda x score) = sum of weights.

    1 if clean text has no positive score; at most 5.
    """
    if not len(scores) or (scores > 0).sum() == 0 or (scores * weights).sum() >= 0:
        return 1.0
    low, high = 1e-3, 5.0
    total = weights.sum()
    if (weights * np.exp(high * scores)).sum() < total:
        return high
    for _ in range(60):
        middle = (low + high) / 2
        if (weights * np.exp(middle * scores)).sum() > total:
            high = middle
        else:
            low = middle
    return (low + high) / 2


def scanned(docs: DataFrame, model: OddsModel) -> DataFrame:
    """Per document: n_tokens, best segment, evidence and the significant passages."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        law = shared.value
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                tokens = tokens_of(text)
                scores = np.fromiter(map(law.token_score, tokens), float, len(tokens))
                segments = maximal_segments(scores)
                best = max((s for _, _, s in segments), default=0.0)
                kept = law.significant(segments, len(tokens))
                value = law.evidence(kept, len(tokens))
                rows.append((doc, len(tokens), best, value, law.probability(value), [dict(zip(("first", "end", "score"), s)) for s in kept]))
            yield pd.DataFrame(rows, columns=["doc_id", "n_tokens", "best", "evidence", "score", "passages"])

    schema = (
        "doc_id string, n_tokens bigint, best double, evidence double, score double, "
        "passages array<struct<first:int,end:int,score:double>>"
    )
    return with_number_id(id_and_text(docs).mapInPandas(scan, schema))


def fit(docs: DataFrame, labels: DataFrame, label: str, at_most: int = SAMPLE_ROWS) -> OddsModel:
    """Odds, extreme-value law and calibration from at most `at_most` labelled rows.

    Without labelled rows of both classes nothing is toxic: no token scores.
    """
    train = stored(sampled(training_labels(labels, label), at_most, seed=3), "labelled")
    classes = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    toxic, other = classes.get(1, 0), classes.get(0, 0)
    if not toxic or not other:
        return OddsModel({})
    # Only labelled texts go to Python.
    rows = docs.select("doc_id", "text").join(F.broadcast(train), "doc_id").select("label", "text")
    share = toxic / (toxic + other)
    n = F.col("toxic") + F.col("other")
    z = F.abs(F.col("toxic") - n * share) / F.sqrt(n * share * (1 - share) + 1)
    telling = token_counts(rows).where(z >= LEAST_Z).select("level")
    telling = context_counts(rows, {bytes(r["level"]) for r in telling.collect()})
    model = OddsModel(token_odds(telling, toxic, other))
    words = [bytes(x) in model.odds and bytes(x)[:1] == b"=" for x in telling["level"]]
    known = telling[np.array(words, bool)]
    scores = np.array([model.odds[bytes(x)] for x in known["level"]])
    # Token rates of clean text: document counts over the words of clean documents.
    first = scanned_training(rows, model)
    if not len(first):
        return OddsModel({})
    clean = first[first["label"] == 0]
    words = max(float(clean["n_tokens"].sum()), 1.0)
    weights = np.append(known["other"].to_numpy(float), max(words - known["other"].sum(), 1.0))
    model.lam = solve_lambda(np.append(scores - DRIFT, -DRIFT), weights)
    # log K from the mean of the extreme-value law, whose reduced mean is Euler's constant.
    some = clean[clean["n_tokens"] > 0]
    if len(some):
        gumbel = model.lam * some["best"] - np.log(some["n_tokens"])
        model.log_k = float(gumbel.mean() - 0.5772)
    # Which segments are significant is known by now: the texts are scanned as they will be scored.
    model.cache = {}
    second = scanned_training(rows, model)
    w = logistic_fit(second["evidence"].to_numpy(float)[:, None], second["label"].to_numpy(float), l2=1e-5, steps=2000)
    model.weights = (float(w[0]), float(w[1]))
    model.cache = {}
    return model


def scanned_training(rows: DataFrame, model: OddsModel) -> pd.DataFrame:
    """Label, length, best segment and evidence of the (bounded) training rows."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        law = shared.value
        for batch in batches:
            out = []
            for label, text in zip(batch["label"], batch["text"]):
                tokens = tokens_of(text)
                scores = np.fromiter(map(law.token_score, tokens), float, len(tokens))
                segments = maximal_segments(scores)
                best = max((s for _, _, s in segments), default=0.0)
                out.append((label, len(tokens), best, law.evidence(law.significant(segments, len(tokens)), len(tokens))))
            yield pd.DataFrame(out, columns=["label", "n_tokens", "best", "evidence"])

    schema = "label int, n_tokens bigint, best double, evidence double"
    found = rows.mapInPandas(scan, schema).toPandas()
    # The order in which rows arrive must not matter to the fit.
    return found.sort_values(list(found.columns), ignore_index=True)


def with_score(docs: DataFrame, model: OddsModel, name: str) -> DataFrame:
    """All columns of `docs` (with `text`) and the score of each row as `name`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        law, found = shared.value, []
        for text in texts:
            tokens = tokens_of(text)
            scores = np.fromiter(map(law.token_score, tokens), float, len(tokens))
            kept = law.significant(maximal_segments(scores), len(tokens))
            found.append(law.probability(law.evidence(kept, len(tokens))))
        return pd.Series(found, dtype=float)

    return docs.withColumn(name, score("text"))


def toxicity_scores(docs: DataFrame, labels: DataFrame, at_most: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, score (0 to 1), n_tokens, evidence and `passages` of every row of `docs`.

    Passages are the significant segments as token ranges with scores. NULL,
    empty and wordless texts have no passages and the lowest score; repeated
    rows score alike. Columns other than doc_id and text are not looked at.
    """
    return scanned(docs, fit(docs, labels, "toxic", at_most))
