"""Collocations against a brute-force count."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from courierlake.llm import phrases
from courierlake.llm.common import ship

SCHEMA = "doc_id bigint, text string, lang string, rank string, n string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def brute(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            inside = any(
                100 * b >= 50 * a
                for q, b in candidates.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            )
            if not inside:
                cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def corpus(seed, docs=60):
    rng = np.random.default_rng(seed)
    words = ["New", "york", "CITY", "été", "a", "of", "the", "x" * 300, "b c", "日本", *(f"w{i}" for i in range(40))]
    weights = 1 / np.arange(1, len(words) + 1)
    ends = [" "] * 6 + ["  ", "\t", ". ", ", ", "\n", "\r\n", "!? ", " \x0b"]
    rows = []
    for i in range(docs):
        picked = rng.choice(words, int(rng.integers(0, 120)), p=weights / weights.sum())
        text = "".join(w + ends[int(rng.integers(len(ends)))] for w in picked)
        if i % 3 == 0:
            text += "new york city hall new york city hall"
        rows.append((text, [None, "und", "en", "de"][i % 4]))
    rows += [(None, "en"), ("", None), (" .,;\n", "fr"), ("alone", "it"), ("the " * 5000, "en")]
    return rows + rows[:7]


def found(spark, rows, **options):
    table = spark.createDataFrame([(i, t, lang, "a", "b") for i, (t, lang) in enumerate(rows)], SCHEMA)
    return sorted(tuple(r) for r in phrases.collocations(table.repartition(5), **options).collect())


@pytest.mark.parametrize("hot_words, hot_pairs", [(250_000, 1_000_000), (6, 4), (0, 0), (30, 0)])
def test_equals_brute_force(spark, hot_words, hot_pairs):
    """Whatever is broadcast, also nothing."""
    rows = corpus(1)
    expected = brute(rows, 4, 25)
    assert len(expected) > 60 and any(len(r[2].split(" ")) == 3 for r in expected)
    assert found(spark, rows, top=25, least=4, hot_words=hot_words, hot_pairs=hot_pairs) == expected


def test_full_tiles_and_the_sums_of_many_flushes(spark, monkeypatch):
    first, second = np.random.default_rng(2).integers(0, 3000, (2, 400_000))
    first[:300_000] %= 900
    second[:300_000] %= 900
    expected = Counter(zip(first.tolist(), second.tolist()))
    a, b, n = phrases.tiled_counts(first, second)
    assert dict(zip(zip(a.tolist(), b.tolist()), n.tolist())) == expected and len(a) == len(expected)
    empty = np.zeros(0, np.int64)
    assert [len(x) for x in phrases.tiled_counts(empty, empty)] == [0, 0, 0]


def test_packed_numbers():
    numbers = np.concatenate([np.random.default_rng(1).integers(0, 1 << 60, 999), [0, 1, (1 << 63) - 1]])
    assert (phrases.unpack(phrases.pack(numbers)) == numbers).all() and len(phrases.unpack(phrases.pack(numbers[:0]))) == 0
    buckets = phrases.bucket_of(numbers, 7)
    assert set(buckets.tolist()) == set(range(7))
    codes, n = phrases._merged([numbers[:600], numbers[300:]], [np.full(600, 2), np.full(len(numbers) - 300, 5)])
    assert dict(zip(codes[0].tolist(), n[0].tolist())) == {
        x: 2 * (i < 600) + 5 * (i >= 300) for i, x in enumerate(numbers.tolist())
    }


def test_scores_beyond_64_bits(spark):
    big = spark.createDataFrame([(10**12, 10**12 + 7, 3 * 10**12 + 1)], "a bigint, l bigint, r bigint")
    a, left, right = 10**12, 10**12 + 7, 3 * 10**12 + 1
    score = big.select(phrases._score(big.a, big.l, big.r)).first()[0]
    assert score == 1_000_000 * a * a // (left * right)


def test_names_agree_between_spark_and_tasks(spark):
    row = spark.createDataFrame([("en", "été word")], "lang string, phrase string")
    name = row.select(phrases.name_column(row.lang, row.phrase)).first()[0]
    assert name == phrases._name(b"en", "été word".encode())


def test_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, None), ("", "en")]) == []
