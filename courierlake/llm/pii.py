"""Personal data: e-mail addresses, IP addresses, card and phone numbers.

Four patterns give the base spans, which always stay. Generators of high recall
propose further, overlapping spans: addresses with spelled or bracketed signs,
groups of digits with any separators, windows inside longer runs. Boosted trees
judge them by their format and their surroundings, and those above a calibrated
threshold are taken, best first, where nothing is taken yet.

No table says what personal data is, so the trees learn from the base spans of a
bounded sample: as they stand, and in disguise (other separators and signs,
numbers in front), inside their own surroundings. Everything else that the
generators propose there counts against: windows cut wrongly, the other numbers
of the texts, and decoys (dates, amounts, ids, card numbers with a wrong digit)
in place of the base spans.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.llm.common import stored, with_number_id

KINDS = ("email", "ip", "card", "phone")
# Documents the trees are fitted on, about; and candidates of one document among those.
SAMPLE_DOCS, SAMPLE_CANDIDATES = 6_000, 40
# Share of true spans that a threshold must reach on held-out candidates, and base spans it takes to set one.
PRECISION, LEAST_SPANS = 0.97, 100

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Addresses lie inside runs of digits and points, which are found first. A match can't start
# inside a run of digits: if the run's start fails, so does the rest of it.
_NUMERIC = re.compile(r"[0-9][0-9.]*+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _small(part: str) -> bool:
    """At most 255, however many zeros lead."""
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: from every @ back over the local part, not into the last address."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """start, kind (its place in KINDS), end of the base spans, in order."""
    found = [(start, 0, end) for start, end in _emails(text)]
    for run in _NUMERIC.finditer(text):
        if run.end() - run.start() >= 7:
            numbers = _IP.finditer(text, *run.span())
            found += [(m.start(), 1, m.end()) for m in numbers if all(map(_small, m.groups()))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NO_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NO_DIGIT.sub("", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


# Signs of an address, plain or in disguise.
_SIGN = r"(?:at|At|AT|@)"
_AT = re.compile(
    rf"@|\[ ?{_SIGN} ?\]|\( ?{_SIGN} ?\)|\{{ ?{_SIGN} ?\}}|< ?{_SIGN} ?>| {_SIGN} "
)
_DOT = r"(?: ?[\[({<] ?(?:dot|Dot|DOT|\.) ?[\])}>] ?| (?:dot|Dot|DOT|\.) |\.)"
_LABELS = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,5}}")
_DOTTED = re.compile(rf"[0-9][0-9]{{0,2}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?![0-9])")
# Digits in groups with up to three other signs between them.
_RUNS = re.compile(r"[0-9][0-9]*+(?:[\x20().\-‐-―/_·:,]{1,3}[0-9]++)*+")
_GROUP = re.compile(r"[0-9]+")
MOST_DIGITS, LEAST_DIGITS = 19, 9


def _address(text: str, sign: re.Match) -> tuple[int, int, int] | None:
    """start, place of the sign, end of the address around a sign; blanks beside brackets belong to it."""
    at, after = sign.span()
    if after - at > 2 and text[at] != " ":
        at -= at > 0 and text[at - 1] == " "
        after += text[after : after + 1] == " "
    start = at
    while start and at - start < 64 and text[start - 1] in _LOCAL:
        start -= 1
    labels = _LABELS.match(text, after) if start < at else None
    return (start, at, labels.end()) if labels else None


def candidates(text: str) -> Iterator[tuple[int, int, int]]:
    """start, kind, end of everything that may be personal data; spans overlap."""
    for sign in _AT.finditer(text):
        address = _address(text, sign)
        if address:
            yield address[0], 0, address[2]
    m = _DOTTED.search(text)
    while m:
        if not text[m.start() - 1 : m.start()].isdigit():
            yield m.start(), 1, m.end()
        m = _DOTTED.search(text, _GROUP.match(text, m.start()).end())
    for run in _RUNS.finditer(text):
        if run.end() - run.start() < LEAST_DIGITS:
            continue
        groups = [m.span() for m in _GROUP.finditer(text, *run.span())]
        for i, (start, _) in enumerate(groups):
            digits = 0
            for j in range(i, len(groups)):
                digits += groups[j][1] - groups[j][0]
                if digits > MOST_DIGITS:
                    break
                if digits >= 12:
                    yield start, 2, groups[j][1]
                if LEAST_DIGITS <= digits <= 15:
                    yield start - _opening(text, start), 3, groups[j][1]


def _opening(text: str, start: int) -> int:
    """Signs before the first digit that belong to a phone number: + or an open parenthesis."""
    return 1 if start and text[start - 1] in "+(" else 0


_KEYWORDS = tuple(
    re.compile(words, re.IGNORECASE)
    for words in (r"mail|contact|write|@", r"\bip\b|host|server|addr", r"card|visa|credit|pay|carte|karte", r"tel|phone|call|fax|mobil")
)


def _class(c: str) -> int:
    """0 no character, 1 blank, 2 letter, 3 digit, 4 full stop or comma, 5 another."""
    return 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4 if c in ".," else 5


def features(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format of a span and what is around it."""
    span, before, after = text[start:end], text[max(0, start - 24) : start], text[end : end + 24]
    groups = _GROUP.findall(span)
    digits = "".join(groups)
    between = _GROUP.split(span)
    separators = [s for s in between[1:-1]]
    sizes = [len(g) for g in groups] or [0]
    around = [
        _class(before[-1:]),
        _class(after[:1]),
        _class(after[1:2]),
        sum(c.isdigit() for c in before),
        sum(c.isdigit() for c in after),
        sum(c.isalpha() for c in before),
        sum(c.isalpha() for c in after),
        before.rstrip()[-1:] in (":", "#", "="),
        *(word.search(before) is not None for word in _KEYWORDS),
    ]
    if kind == 0:
        sign = _AT.search(span)
        local, domain = span[: sign.start()].rstrip(), span[sign.end() :].lstrip()
        dots = re.findall(_DOT, domain)
        labels = re.split(_DOT, domain)
        written = len(span) - len(local) - len(domain)
        marks = sign.group().strip().lower()
        return around + [
            len(local),
            sum(c.isdigit() for c in local),
            sum(c in "._%+-" for c in local),
            local[:1].isupper(),
            len(labels),
            len(labels[-1]),
            labels[-1].isalpha(),
            labels[-1].islower(),
            max(map(len, labels)),
            sum(c.isdigit() for c in domain),
            0 if marks == "@" else 1 if marks == "at" else 2,
            written - len(marks),
            len(set(dots)),
            0 if not dots else 0 if dots[-1] == "." else 1 if dots[-1].strip() in (".", "dot") else 2,
            domain[-1:] in ".-",
        ]
    return around + [
        len(span),
        len(digits),
        len(groups),
        max(sizes),
        min(sizes),
        sizes[0],
        sizes[-1],
        len(set(digits)),
        int(digits[0]) if digits else -1,
        digits.startswith("00"),
        between[0] == "+",
        between[0] == "(",
        len(set(separators)),
        sum(s == " " for s in separators),
        sum(s == "-" for s in separators),
        sum(s == "." for s in separators),
        sum("(" in s or ")" in s for s in between),
        sum(":" in s or "," in s or "/" in s for s in separators),
        max(map(len, separators), default=0),
        luhn(digits),
        all(map(_small, groups)),
        all(len(g) == 4 for g in groups[:-1]),
    ]


# Disguises and decoys, by kind. Fixed values.
_SIGNS = ((" at ", " dot "), ("(at)", "(dot)"), ("[at]", "[dot]"), (" [at] ", " [dot] "), (" @ ", "."), ("[at]", "."), (" (at) ", "."), ("@", "[.]"))
_POINTS = ("[.]", "(.)", " . ", "[dot]", " dot ")
_BREAKS = (".", "/", "_", "–", " - ", ". ", "  ")


def _grouped(digits: str, rng: np.random.Generator) -> list[str]:
    return [digits[i : i + 4] for i in range(0, len(digits), 4)]


def disguised(kind: int, span: str, rng: np.random.Generator) -> tuple[str, str]:
    """A span written differently, and what stands right before it then."""
    pick = lambda options: options[int(rng.integers(len(options)))]
    if kind == 0:
        at, dot = pick(_SIGNS)
        local, domain = span.split("@", 1)
        return f"{local}{at}{domain.replace('.', dot)}", ""
    if kind == 1:
        return span.replace(".", pick(_POINTS)), ""
    digits = _NO_DIGIT.sub("", span)
    front = pick(("", "", f"{int(rng.integers(1, 99))} ", f"{int(rng.integers(1, 99))}. "))
    if kind == 2:
        if rng.random() < 0.3:
            return span, f"{int(rng.integers(1, 99))} "
        return pick(_BREAKS).join(_grouped(digits, rng)), front if rng.random() < 0.3 else ""
    form = int(rng.integers(4))
    if form == 0 and len(_GROUP.findall(span)) > 2:
        return span[1:], ""
    if form == 1:
        return "00" + span[1:], ""
    last, middle, first = digits[-4:], digits[-7:-4], digits[:-7]
    if form == 2 and len(first) >= 3:
        return f"({first[-3:]}) {middle}-{last}", ""
    return "+" + pick(("/", " / ", "–", "_")).join((first or "1", middle, last)), ""


def decoy(rng: np.random.Generator) -> str:
    """A number that is no personal data, in a shape that may look like it."""
    number = lambda low, high: int(rng.integers(low, high))
    digits = lambda n: "".join(str(number(0, 10)) for _ in range(n))
    card = str(number(1, 10)) + digits(number(11, 17))
    while luhn(card):
        card = card[:-1] + str(number(0, 10))
    shapes = (
        f"{number(1900, 2030)}-{number(1, 13):02d}-{number(1, 29):02d} {number(0, 24):02d}:{number(0, 60):02d}:{number(0, 60):02d}",
        f"{number(1, 29):02d}/{number(1, 13):02d}/{number(1900, 2030)} {number(0, 24):02d}:{number(0, 60):02d}",
        f"{number(1, 29):02d}.{number(1, 13):02d}.{number(1900, 2030)}, {number(1, 29):02d}.{number(1, 13):02d}.{number(1900, 2030)}",
        f"{number(1, 999)},{digits(3)},{digits(3)}.{digits(2)}",
        f"{number(0, 90)}.{digits(6)}, {number(0, 180)}.{digits(6)}",
        f"{number(0, 20)}.{digits(number(9, 14))}",
        digits(number(9, 16)),
        "-".join(digits(number(1, 5)) for _ in range(number(3, 6))),
        " ".join(str(number(1, 100)) for _ in range(number(6, 12))),
        ", ".join(str(number(1, 1000)) for _ in range(number(4, 9))),
        f"{number(1900, 2000)}-{number(1900, 2030)}, {number(1900, 2000)}-{number(1900, 2030)}",
        f"{number(1, 30)}.{number(0, 30)}.{number(0, 99)}.{number(256, 9999)}",
        card,
        " ".join(_grouped(card, rng)),
        "-".join(_grouped(card, rng)),
    )
    return shapes[number(0, len(shapes))]


def _point_decoy(rng: np.random.Generator) -> str:
    """Numbers between points that are no address: too large, too many, or a count."""
    number = lambda low, high: int(rng.integers(low, high))
    point = (".", *_POINTS)[number(0, 1 + len(_POINTS))]
    shapes = (
        [number(256, 1000), number(0, 256), number(0, 256), number(0, 256)],
        [number(0, 256), number(0, 256), number(0, 256), number(256, 1000)],
        [number(0, 30) for _ in range(number(5, 9))],
    )
    first = number(1, 10)
    if number(0, 4) == 0:
        return " . ".join(str(first + i) for i in range(number(4, 9)))
    return point.join(map(str, shapes[number(0, 3)]))


_WORD = re.compile(r"[^\W\d_]{2,}")


def _mail_decoy(before: str, rng: np.random.Generator) -> str:
    """Words of the text around a sign that is no address."""
    words = (_WORD.findall(before) or ["here"]) + ["home"]
    a, b, c = (words[int(rng.integers(len(words)))] for _ in range(3))
    return (f"{a} at {b}. {c}", f"{a} at {b}.{c.title()}", f"@{a} {b}. {c}", f"{a}@{b}", f"{a} @ {b} . {c}", f"{a} at {b} dot {c}")[
        int(rng.integers(6))
    ]


def examples(text: str) -> list[tuple[int, bool, list[float]]]:
    """kind, is personal data, and features of candidates around the base spans of a text and its other numbers."""
    found, base = [], base_spans(text)
    true = {(s, k, e) for s, k, e in base}
    rng = np.random.default_rng(int.from_bytes(hashlib.sha256(text.encode("utf-8", "replace")).digest()[:8], "little"))
    covered = _Taken(base)
    natural = [c for c in candidates(text) if c in true or not covered.meets(c[0], c[2])]
    for i in rng.permutation(len(natural))[:SAMPLE_CANDIDATES]:
        start, kind, end = natural[i]
        found.append((kind, natural[i] in true, features(text, start, kind, end)))
    for i in rng.permutation(len(base))[: SAMPLE_CANDIDATES // 4]:
        start, kind, end = base[i]
        before, after = text[max(0, start - 60) : start], text[end : end + 60]
        written, front = disguised(kind, text[start:end], rng)
        head = before + front
        mine = (len(head), kind, len(head) + len(written))
        hoax = _mail_decoy(before, rng) if kind == 0 else _point_decoy(rng) if kind == 1 else decoy(rng)
        for snippet, place in ((head + written + after, mine), (before + hoax + after, None)):
            inside = (len(before), len(snippet) - len(after))
            near = [c for c in candidates(snippet) if c[0] < inside[1] and c[2] > inside[0]]
            for c in sorted(near, key=lambda c: c != place)[: SAMPLE_CANDIDATES // 4]:
                found.append((c[1], c == place, features(snippet, *c)))
    return found


class _Taken:
    """Spans that are taken already; asked for overlaps."""

    def __init__(self, spans: list[tuple[int, int, int]] = ()) -> None:
        self.starts = sorted(start for start, _, _ in spans)
        # Base spans of different kinds may overlap: the furthest end so far.
        self.ends = list(accumulate((end for _, _, end in sorted((s, 0, e) for s, _, e in spans)), max))

    def meets(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end) - 1
        return at >= 0 and self.ends[at] > start

    def add(self, start: int, end: int) -> None:
        """A span that meets none."""
        at = bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


@dataclass
class Boosted:
    """Regression trees of fixed depth on binned features, summed to a log-odds."""

    cuts: list[np.ndarray]
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    start: float = 0.0
    threshold: float = np.inf

    DEPTH, TREES, RATE, BINS, L2 = 4, 60, 0.2, 32, 1.0

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Boosted:
        """Newton boosting of the logistic loss; a split is the best of all bins."""
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, cls.BINS)[1:-1], method="lower")) for c in x.T]
        model = cls(cuts)
        binned = model.binned(x)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        model.start = float(np.log(share / (1 - share)))
        score = np.full(len(y), model.start)
        for _ in range(cls.TREES):
            p = 1 / (1 + np.exp(-score))
            tree = cls._grow(binned, y - p, p * (1 - p))
            model.trees.append(tree)
            score += cls._leaf(tree, binned)
        return model

    @classmethod
    def _grow(cls, binned: np.ndarray, gradient: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
        inner = (1 << cls.DEPTH) - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, cls.BINS, np.int64)
        node = np.zeros(len(binned), np.int64)
        for depth in range(cls.DEPTH):
            first, n = (1 << depth) - 1, 1 << depth
            best = np.full(n, 1e-9)
            for f in range(binned.shape[1]):
                cell = (node - first) * cls.BINS + binned[:, f]
                g = np.bincount(cell, gradient, n * cls.BINS).reshape(n, -1).cumsum(1)
                h = np.bincount(cell, weight, n * cls.BINS).reshape(n, -1).cumsum(1)
                total_g, total_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + cls.L2) + (total_g - g) ** 2 / (total_h - h + cls.L2) - total_g**2 / (total_h + cls.L2)
                at = gain.argmax(1)
                gain = gain[np.arange(n), at]
                better = gain > best
                best[better] = gain[better]
                feature[first : first + n][better] = f
                cut[first : first + n][better] = at[better]
            node = 2 * node + 1 + (binned[np.arange(len(node)), feature[node]] > cut[node])
        g = np.bincount(node - inner, gradient, inner + 1)
        h = np.bincount(node - inner, weight, inner + 1)
        return feature, cut, cls.RATE * g / (h + cls.L2)

    @classmethod
    def _leaf(cls, tree: tuple[np.ndarray, ...], binned: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        node, rows = np.zeros(len(binned), np.int64), np.arange(len(binned))
        for _ in range(cls.DEPTH):
            node = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
        return value[node - len(feature)]

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, column, "left") for c, column in zip(self.cuts, x.T)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of the rows."""
        binned = self.binned(x)
        return self.start + sum(self._leaf(tree, binned) for tree in self.trees)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Set the threshold where held-out candidates hold PRECISION.

        The share of true spans is made to rise with the score by pooling
        (isotonic regression); the threshold is the lowest score of the pools
        that reach PRECISION, counting one wrong span more than was seen.
        """
        score = self.score(x)
        order = np.argsort(score, kind="stable")
        pools: list[list[float]] = []
        for s, t in zip(score[order].tolist(), y[order].tolist()):
            pools.append([t, 1.0, s])
            while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
                true, n, _ = pools.pop()
                pools[-1][0] += true
                pools[-1][1] += n
        true = n = 0.0
        for right, size, lowest in reversed(pools):
            true, n = true + right, n + size
            if right < PRECISION * size or true < PRECISION * (n + 1):
                break
            self.threshold = lowest


FOLDS = 3


def fit(docs: DataFrame) -> dict[int, Boosted]:
    """Trees by kind, learned from about SAMPLE_DOCS documents with a digit or an @.

    A kind with fewer than LEAST_SPANS base spans in the sample gets none, so
    only its base spans are found.
    """
    rows = docs.select("doc_id", "text").where(F.col("text").rlike("[0-9@]"))
    share = min(1.0, SAMPLE_DOCS / max(rows.count(), 1))
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit(12)), F.lit(1 << 30))
    # The limit bounds the sample where one row is repeated without end.
    taken = rows.where(place < int(share * (1 << 30)) + 1).limit(2 * SAMPLE_DOCS)

    def told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (int(hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()[:8], 16) % FOLDS, kind, label, np.asarray(x, np.float32))
                for text in batch["text"]
                for kind, label, x in examples(text)
            ]
            yield pd.DataFrame(rows, columns=["fold", "kind", "label", "x"])

    schema = "fold int, kind int, label boolean, x array<float>"
    found = stored(taken.select("text").mapInPandas(told, schema), "pii-examples").toArrow().to_pandas()
    models = {}
    for kind in range(len(KINDS)):
        mine = found[found["kind"] == kind]
        if mine["label"].sum() < LEAST_SPANS:
            continue
        x, y, fold = np.stack(mine["x"]), mine["label"].to_numpy(float), mine["fold"].to_numpy()
        # The order in which rows arrive must not matter.
        order = np.lexsort((*x.T, y, fold))
        x, y, fold = x[order], y[order], fold[order]
        if 0 < y[fold > 0].sum() < (fold > 0).sum():
            models[kind] = Boosted.fit(x[fold > 0], y[fold > 0])
            if (fold == 0).any():
                models[kind].calibrate(x[fold == 0], y[fold == 0])
    return models


def added_spans(texts: list[str], base: list[list[tuple[int, int, int]]], models: dict[int, Boosted]) -> list[list[tuple]]:
    """start, kind, end, log-odds above the threshold, of the spans added to each text, in order."""
    asked: dict[int, list[tuple]] = {k: [] for k in models}
    for i, text in enumerate(texts):
        covered = _Taken(base[i])
        for start, kind, end in candidates(text):
            if kind in models and not covered.meets(start, end):
                asked[kind].append((i, start, end, features(text, start, kind, end)))
    passed: list[list[tuple]] = [[] for _ in texts]
    for kind, some in asked.items():
        if some:
            model = models[kind]
            margin = model.score(np.array([f for *_, f in some], np.float32)) - model.threshold
            for j in np.flatnonzero(margin >= 0).tolist():
                i, start, end, _ = some[j]
                passed[i].append((-float(margin[j]), start - end, start, kind, end))
    out = []
    for spans in passed:
        taken, chosen = _Taken(), []
        for margin, _, start, kind, end in sorted(spans):
            if not taken.meets(start, end):
                taken.add(start, end)
                chosen.append((start, kind, end, -margin))
        out.append(sorted(chosen))
    return out


def listed(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_spans(docs: DataFrame, models: dict[int, Boosted] | None = None, redacted: bool = False) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added; with `redacted` also the text without them.

    The counts and the digest are those of the base spans; `spans` has all, in
    order of start and kind, as kind:start:end in code points. In the redacted
    text each span, or spans that overlap, becomes the first one's kind in
    brackets. NULL and empty texts have no spans; every row, also repeated ones
    and those without an id, gives one row. An empty table gives none. Columns
    other than doc_id and text are not looked at.
    """
    models = fit(docs) if models is None else models
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                texts = [t if isinstance(t, str) else "" for t in part["text"]]
                base = [base_spans(t) for t in texts]
                added = added_spans(texts, base, shared.value)
                both = [sorted(b + [a[:3] for a in more]) for b, more in zip(base, added)]
                columns = {"doc_id": part["doc_id"].to_numpy()}
                for kind, name in enumerate(KINDS):
                    columns[f"n_{name}"] = [sum(k == kind for _, k, _ in b) for b in base]
                columns["base_sha256"] = [hashlib.sha256(listed(b).encode()).hexdigest() for b in base]
                columns["spans"] = [listed(b) for b in both]
                columns["n_added"] = [len(a) for a in added]
                if redacted:
                    columns["redacted"] = [
                        _without(t, s) if isinstance(raw, str) else None for raw, t, s in zip(part["text"], texts, both)
                    ]
                yield pd.DataFrame(columns)

    schema = "doc_id string, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return with_number_id(rows.mapInPandas(found, schema + (", redacted string" if redacted else "")))


def _without(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]
