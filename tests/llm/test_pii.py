"""Base spans against the plain patterns; added spans on written disguises."""

import hashlib
import re

import numpy as np
import pytest

from courierlake.llm import pii
from courierlake.llm.common import ship

SCHEMA = "doc_id bigint, text string, spans string, n_email int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def holds(kind, match):
    digits = [int(c) for c in re.sub("[^0-9]", "", match)]
    if kind == 1:
        return all(int(part) <= 255 for part in match.split("."))
    if kind == 2:
        doubled = sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2])
        return 12 <= len(digits) <= 19 and (doubled + sum(digits[-1::-2])) % 10 == 0
    return kind == 0 or 9 <= len(digits) <= 15


def plain(text):
    return sorted(
        (m.start(), kind, m.end())
        for kind, pattern in enumerate(PATTERNS)
        for m in re.finditer(pattern, text)
        if holds(kind, m.group())
    )


ODD = [
    "a@b.c@d.e f@g @h.i j@k. l@m.n-o@p.q é@x.yz ü.v@w-.-x. a.@-.-",
    "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.255 1.2.3 1..2.3.4 9999.1.2.3.4 0.0.0.256.1.1.1",
    "4111111111111111 4111 1111 1111 1111 4111-1111-1111-1112 5 4111111111111111 4111  1111111111110",
    "+1 (988) 555-2485 +1(((((2 +49.30.1234567- +123456789012345678 + 1 555 +1+1 (988) 555-2485",
    "x" * 50_000 + "@" + "y" * 50_000,
    "7" * 40_000,
    "1.2." * 5_000,
    "a@" * 5_000 + "b.c",
    "+1" + " ()" * 20_000,
]


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(5)
    signs = list("ab1029.@+-() %_é") + ["4111111111111111", "a@b.c", "10.0.0.1", "+1 988 555 2485"]
    texts = ODD[:4] + ["".join(rng.choice(signs, int(rng.integers(0, 60)))) for _ in range(4000)]
    for text in texts:
        assert pii.base_spans(text) == plain(text)
    assert sum(map(len, map(plain, texts))) > 3000


def test_long_runs_take_linear_time():
    for text in ODD[4:]:
        assert len(pii.base_spans(text)) < 10_000
        assert sum(1 for _ in pii.candidates(text)) < 400_000


def person(rng):
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    card = "4" + digits(14)
    card += next(c for c in "0123456789" if pii.luhn(card + c))
    return [
        f"{''.join(rng.choice(list('abcdefgh'), 5))}.{digits(2)}@mail{digits(1)}.example.com",
        ".".join(str(n) for n in rng.integers(1, 255, 4)),
        card,
        f"+1 ({rng.integers(200, 999)}) 555-{digits(4)}",
    ]


def sentence(rng):
    return " ".join("".join(rng.choice(list("abcdeilmnorst"), int(rng.integers(2, 9)))) for _ in range(12))


def corpus(spark, n, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        text = f"{sentence(rng)}. {person(rng)[i % 4]} {sentence(rng)}"
        if i % 7 == 0:
            text += f" on {rng.integers(1900, 2030)}-01-1{i % 10} 10:22:{i % 60:02d} for {rng.integers(1, 99)},{rng.integers(100, 999)}.50."
        rows.append((i, text, "x", 1))
    return spark.createDataFrame(rows, SCHEMA).repartition(4), rows


@pytest.fixture(scope="module")
def models(spark):
    return pii.fit(corpus(spark, 2000, 1)[0])


def test_disguises_are_found_and_other_numbers_left_alone(spark, models):
    assert set(models) == {0, 1, 2, 3}
    rng = np.random.default_rng(9)
    found = wanted = 0
    for i in range(400):
        kind = i % 4
        span = person(rng)[kind]
        written, front = pii.disguised(kind, span, rng)
        before, after = sentence(rng) + " " + front, " " + sentence(rng)
        text = before + written + after
        if (len(before), kind, len(before) + len(written)) in pii.base_spans(text):
            continue
        wanted += 1
        added = pii.added_spans([text], [pii.base_spans(text)], models)[0]
        found += any(s[:3] == (len(before), kind, len(before) + len(written)) for s in added)
    assert wanted > 200 and found >= 0.9 * wanted
    clean = [f"{sentence(rng)} {pii.decoy(rng)} {sentence(rng)}, look at home. {sentence(rng)}" for _ in range(400)]
    added = pii.added_spans(clean, [pii.base_spans(t) for t in clean], models)
    assert sum(map(len, added)) <= 8


def test_rows_of_the_query(spark, models):
    awkward = [(None, None), (None, "a@b.c"), (1, ""), (2, None), (3, "é a@b.c, 1.2.3.4"), (3, "é a@b.c, 1.2.3.4"), *((10 + i, t) for i, t in enumerate(ODD))]
    docs = spark.createDataFrame([(*r, "x", 1) for r in awkward], SCHEMA)
    rows = pii.find_spans(docs, models, redacted=True).collect()
    assert sorted((r.doc_id or 0, r.spans.split(",")[0]) for r in rows)[:2] == [(0, ""), (0, "email:0:5")]
    assert len(rows) == len(awkward)
    texts = {r[0]: r[1] for r in awkward if r[0] is not None}
    for row in rows:
        if row.doc_id is None:
            continue
        base = plain(texts[row.doc_id] or "") if len(texts[row.doc_id] or "") < 10_000 else pii.base_spans(texts[row.doc_id])
        written = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert row.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == kind for _, k, _ in base) for kind in range(4)]
        assert not base or set(written.split(",")) <= set(row.spans.split(","))
        assert row.n_added == (len(row.spans.split(",")) if row.spans else 0) - len(base)
    assert {r.redacted for r in rows if r.doc_id == 3} == {"é [EMAIL], [IP]"}


def test_without_enough_base_spans_only_these_are_found(spark):
    docs, rows = corpus(spark, 40, 2)
    assert pii.fit(docs) == {}
    found = {r.doc_id: r.spans for r in pii.find_spans(docs).collect()}
    assert found == {i: ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in plain(t)) for i, t, *_ in rows}
    assert pii.find_spans(docs.limit(0)).collect() == []
