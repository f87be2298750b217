"""The filter audit against a run of every order, document by document."""

import re
from itertools import permutations

import numpy as np
import pytest

from courierlake.llm import interactions
from courierlake.llm.common import ship

DOCS = "doc_id bigint, text string, source string, part string, failed int, n int"
LABELS = "doc_id bigint, quality int, toxic int, part string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 50,
        "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        "D": re.search(r"[#$%&*|]", text) is not None,
    }


def brute(docs, labels):
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    parts = {}
    for doc_id, text, source in docs:
        text = text or ""
        failed = fails(text)
        failed["E"] = doc_id is not None and any(
            (other or "") == text and i is not None and i < doc_id for i, other, _ in docs
        )
        parts.setdefault(source or "", []).append((doc_id, {f for f, v in failed.items() if v}))
    out, shapley = [], {}
    for part, rows in parts.items():
        for order in permutations("ABCDE"):
            left = list(rows)
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                out.append(
                    [
                        part,
                        "".join(order),
                        step,
                        len(left),
                        len(gone),
                        sum(f in s for _, s in rows) - len(gone),
                        sum(s == {f} for _, s in rows),
                        sum(d in good for d, _ in gone),
                        sum(d in toxic for d, _ in gone),
                    ]
                )
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def documents(seed):
    rng = np.random.default_rng(seed)
    words = ["aa", "bb", "Cc", "DD", "é", "x#", "y|", " z", *(f"w{i}" for i in range(80))]
    rows = []
    for i in range(120):
        size = int(rng.choice([0, 1, 49, 50, 60, 90]))
        pool = words[int(rng.integers(0, 8)) :][: int(rng.choice([30, 88]))]
        text = " ".join(rng.choice(pool, size))
        rows.append((int(rng.integers(0, 200)), text, ["s1", "s2", None, "", "S3"][int(rng.integers(5))]))
    rows += [(1000 + i, rows[i % 7][1], "copies") for i in range(40)]
    rows += [(None, rows[0][1], "s1"), (None, None, None), (5, None, "s1"), (6, "", "s2"), (6, "", "s2")]
    rows += [(300, "\ta\x0bB\x0c" * 40_000, "long"), (301, "Ü" * 5000, "long")]
    return rows


def found(spark, docs, labels):
    table = spark.createDataFrame([(*d, "x", 7, 9) for d in docs], DOCS).repartition(4)
    marks = spark.createDataFrame([(*r, "y") for r in labels], LABELS)
    return sorted(tuple(r) for r in interactions.interaction_audit(table, marks).collect())


def test_equals_every_order_run_out(spark):
    docs = documents(4)
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 200, 2)]
    labels += [(4, 1, None), (4, 0, 1), (None, 1, 1), (8, None, None), (1003, 1, 1)]
    expected = brute(docs, labels)
    assert any(r[7] for r in expected) and any(r[8] for r in expected) and any(r[5] for r in expected)
    assert found(spark, docs, labels) == expected


def test_empty_tables(spark):
    assert found(spark, [], []) == []
    assert {tuple(r[3:]) for r in found(spark, [(1, "word " * 60, None)], [])} == {
        (1, 0, 0, 0, 0, 0, 0),
        (0, 1, 0, 1, 0, 0, 120),
        (0, 0, 0, 0, 0, 0, 0),
    }


def test_potential_equals_the_mean_over_orders():
    counts = np.random.default_rng(1).integers(0, 10**14, (3, 32))
    values = interactions.coalition_values(counts)
    potential = interactions.potentials(values)
    for i in range(5):
        total = 0
        for order in permutations(range(5)):
            before = sum(1 << j for j in order[: order.index(i)])
            total = total + values[:, before | 1 << i] - values[:, before]
        assert (potential[:, 31] - potential[:, 31 & ~(1 << i)] == total).all()
