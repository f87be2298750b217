"""Each corpus operator against a brute-force version and on awkward rows."""

import hashlib
import itertools
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from courierlake.llm import dedup, lm, mixing, packing, quality, sharding, topk, toxicity, warc, winnow
from courierlake.llm.common import ship
from courierlake.llm.queries import queries

RNG = np.random.default_rng(3)
WORDS = [f"w{i}" for i in range(300)]


def text_of(n, rng=RNG):
    return " ".join(rng.choice(WORDS, n))


def near_copy(text, changes, rng=RNG):
    words = text.split()
    for i in rng.choice(len(words), changes, replace=False):
        words[i] = f"x{rng.integers(1000)}"
    return " ".join(words)


BASE = [text_of(n) for n in (120, 90, 200, 60)]
AWKWARD = [
    (None, None),
    (None, "no id here"),
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one"),
    (5, "one"),
    (6, "ONE  "),
    (7, "same row"),
    (7, "same row"),
    (7, "same id, other text"),
    (8, "x" * 60_000),
    (9, "ü" * 3000 + " end"),
    *((10 + i, t) for i, t in enumerate(BASE)),
    *((20 + i, near_copy(BASE[i % 4], 2)) for i in range(12)),
    (40, BASE[0].upper()),
    (41, text_of(5000)),
]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="module")
def awkward(spark):
    """Rows with NULLs, repeats, long texts, and columns named like those of the operators."""
    docs = spark.createDataFrame(AWKWARD, "doc_id bigint, text string")
    return docs.select("*", F.lit("s").alias("source"), *(F.lit(1).alias(c) for c in ("size", "shard", "score", "node", "_text", "key")))


@pytest.fixture(scope="module")
def nothing(awkward):
    return awkward.where("false")


# --- Sharding ------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 40, 81, 1000])
def test_permutation_is_one(spark, n):
    rows = spark.range(n).select(sharding.permuted(F.col("id"), F.lit(n).cast("bigint"), 5).alias("p"))
    assert sorted(r.p for r in rows.collect()) == list(range(n))


def test_shards(spark, awkward, nothing):
    found = sharding.shard_rows(awkward, 4, seed=2).toPandas()
    assert len(found) == len(AWKWARD)
    sizes = Counter(found["shard"].iloc[:, -1])
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard, rows in found.groupby(found["shard"].iloc[:, -1]):
        assert sorted(rows["slot"]) == list(range(len(rows))), shard
    again = sharding.shard_rows(awkward.repartition(7), 4, seed=2).toPandas()
    key = lambda f: sorted(zip(f["row_number"], f["slot"], f["text"].astype(str)))
    assert key(found) == key(again)
    assert sharding.shard_rows(nothing, 4).count() == 0


# --- Search --------------------------------------------------------------------------


def test_nearest_codes(spark):
    codes = [int(x) for x in RNG.integers(-(2**62), 2**62, 300)]
    codes += [codes[0] ^ (1 << b) for b in range(20)] + [codes[0]] * 30
    rows = [*enumerate(codes), (None, 5), (900, None), (0, codes[0])]
    points = spark.createDataFrame(rows, "id bigint, code bigint")
    found = topk.nearest(points, points.where("id % 25 = 0"), 10).collect()
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: r["rank"]):
        got[r.query_id].append((r.distance, r.neighbor_id))
    for q in range(0, len(codes), 25):
        best = sorted(((codes[q] ^ c) & (2**64 - 1)).bit_count() * 1000 + i for i, c in enumerate(codes) if i != q)
        assert got[q] == [(x // 1000, x % 1000) for x in best[:10]]
    few = points.where("id < 3")
    assert topk.nearest(few, few, 10).count() == 6
    assert topk.nearest(points.where("false"), points, 3).count() == 0


def test_sign_code(spark):
    rows = [([1.0, -1.0, 0.5],), ([float("nan"), None, 2.0],), (None,), ([],)]
    df = spark.createDataFrame(rows, "v array<float>").select(topk.sign_code(F.col("v")).alias("c"))
    assert [r.c for r in df.collect()] == [5, 4, None, 0]


# --- Toxicity ------------------------------------------------------------------------


def all_maximal(scores):
    """By definition: the best segment, then the same to its left and right."""

    def split(low, high):
        best = None
        for a, b in itertools.combinations(range(low, high + 1), 2):
            total = sum(scores[a:b])
            if total > 1e-9 and (best is None or total > best[0] + 1e-9 or abs(total - best[0]) < 1e-9 and b - a < best[2] - best[1]):
                best = (total, a, b)
        if best is None:
            return []
        return [*split(low, best[1]), (best[1], best[2]), *split(best[2], high)]

    return split(0, len(scores))


def test_maximal_segments():
    for seed in range(60):
        scores = np.random.default_rng(seed).normal(-0.2, 1.0, 18)
        assert [(a, b) for a, b, _ in toxicity.maximal_segments(scores)] == all_maximal(scores.tolist())
    assert toxicity.maximal_segments(np.zeros(0)) == []


def labelled(spark, n=400):
    """A third of the documents hold two words from a small list."""
    rng = np.random.default_rng(11)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(list("abcdefgh"), 4)) for _ in range(rng.integers(20, 60))]
        bad = i % 3 == 0
        if bad:
            for w in rng.choice(["scumbag", "idiotic", "moronic"], 3):
                words.insert(int(rng.integers(len(words))), str(w))
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(docs, "doc_id bigint, text string"), labels


def test_toxicity(spark, awkward, nothing):
    docs, labels = labelled(spark)
    table = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id bigint, toxic int")
    found = {r.doc_id: r for r in toxicity.toxicity_scores(docs, table).collect()}
    truth = dict(labels)
    right = sum((found[i].score >= 0.5) == bool(truth[i]) for i in truth)
    assert right >= 0.97 * len(truth)
    toxic = next(r for i, r in found.items() if truth[i] and r.score >= 0.5)
    assert toxic.passages and all(p.first < p.end for p in toxic.passages)
    model = toxicity.fit(docs, table, "toxic")
    scored = toxicity.with_score(awkward, model, "found")
    assert scored.columns == [*awkward.columns, "found"] and scored.count() == len(AWKWARD)
    assert scored.where("found < 0 or found > 1 or found is null").count() == 0
    assert toxicity.toxicity_scores(nothing, table).count() == 0
    # Documents of 500 passages are calibrated as they are scored.
    rng = np.random.default_rng(13)
    body = lambda n: ["".join(rng.choice(list("abcdefgh"), 4)) for _ in range(n)]
    insults = lambda: str(rng.choice(["scumbag", "idiotic", "moronic"]))
    many = [(i, " ".join(w + (" " + insults() if i % 2 else "") + " fine" * 12 for w in body(500))) for i in range(160)]
    marks = spark.createDataFrame([(i, i % 2) for i, _ in many], "doc_id bigint, toxic int")
    long = spark.createDataFrame(many, "doc_id bigint, text string")
    found = {r.doc_id: r for r in toxicity.toxicity_scores(long, marks).collect()}
    assert all((found[i].score >= 0.5) == bool(i % 2) for i in found)
    assert min(len(found[i].passages) for i in found if i % 2) > 400
    untaught = toxicity.toxicity_scores(awkward, table.where("false"))
    assert untaught.where("score >= 0.5").count() == 0


# --- Quality -------------------------------------------------------------------------


def test_quality(spark, awkward, nothing):
    rng = np.random.default_rng(4)
    docs = [(i, "JUNK!! " * int(rng.integers(20, 50)) if i % 4 == 0 else text_of(40, rng)) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(300)], "doc_id bigint, quality int")
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = quality.quality_scores(table, labels).toPandas()
    assert ((found["score"] >= 0.3) == (found["doc_id"] % 4 > 0)).mean() > 0.99
    model = quality.fit(table, labels, "quality")
    scored = quality.with_score(awkward, model, "found").toPandas()
    assert list(scored.columns) == [*awkward.columns, "found"] and len(scored) == len(AWKWARD)
    # The compiled expression equals the rules applied one by one.
    stats = pd.DataFrame([quality.statistics_of(t) for t in scored["text"]], columns=list(quality.STATISTICS))
    values = {s: stats[s].to_numpy() for s in quality.STATISTICS}
    total = model.bias + sum(w * r.holds(values) for r, w in model.rules)
    assert np.allclose(scored["found"], 1 / (1 + np.exp(-total)))
    assert quality.quality_scores(nothing, labels).count() == 0
    assert quality.quality_scores(awkward, labels.where("false")).where("score >= 0.3").count() == len(AWKWARD)


# --- Language model ------------------------------------------------------------------


def test_suffix_tree_scores(spark, awkward, nothing):
    copies = [(100 + i, BASE[2]) for i in range(40)]
    docs = spark.createDataFrame([*AWKWARD, *copies], "doc_id bigint, text string")
    found = lm.score_texts(docs).toPandas()
    fold = lambda i: pd.notna(i) and __import__("zlib").crc32(str(int(i)).encode()) % 7 == 2
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", "" if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
    rows = [*AWKWARD, *copies]
    counts = Counter(w for i, t in rows if not fold(i) for w in [*words(t), "\n"])
    total, distinct = sum(counts.values()), len(counts)
    expected = sorted(
        (sum(np.log10((counts[w] + 1) / (total + distinct + 1)) for w in [*words(t), "\n"]), len(words(t)) + 1, sum(counts[w] > 0 for w in [*words(t), "\n"]))
        for _, t in rows
    )
    got = sorted(zip(found["base_score"], found["n_tokens"], found["n_known"]))
    assert np.allclose(np.array(got, float), np.array(expected, float))
    assert (found["train_tokens"] == total).all() and (found["score"] < 0).all()
    held = found[found["held_out"] & (found["doc_id"] >= 100)]
    assert len(held) and (held["score"] > held["base_score"] + 100).all()
    assert lm.score_texts(nothing).count() == 0


def shared_words(spark, docs):
    words = lm.word_counts(docs).mapInPandas(lm._with_names, "word binary, name bigint, n bigint")
    return spark.sparkContext.broadcast(lm.vocabulary(words)[0])


@pytest.mark.parametrize("numbered", [200_000, 5, 0])
def test_successions_do_not_depend_on_the_split(spark, monkeypatch, numbered):
    """A succession seen once in each of many tasks counts as often as all of them together."""
    monkeypatch.setattr(lm, "HOT_WORDS", numbered)
    rng = np.random.default_rng(6)
    texts = [f"rare pair w{i} {text_of(20, rng)} {text_of(1, rng)} a b c a b" for i in range(50)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    names = {w: lm.name_of(w.encode()) for w in {w for t in texts for w in t.split()}}
    brute = Counter()
    for t in texts:
        row = [lm.START_NAME, *(names[w] for w in t.split()), lm.END_NAME]
        brute.update((1, a, b) for a, b in zip(row, row[1:]))
        pairs = lm._mix(np.array(row[:-1]).astype(np.uint64), np.array(row[1:]).astype(np.uint64)).view(np.int64)
        brute.update((2, int(a), b) for a, b in zip(pairs, row[2:]))
    listed = {k: n for k, n in brute.items() if n >= lm.LEAST_PAIRS}
    found, scores = [], []
    for parts in (1, 50):
        docs = rows.repartition(parts)
        counts = lm.succession_counts(docs, shared_words(spark, docs))
        found.append({(r["order"], r["context"], r["symbol"]): r["n"] for r in counts.collect()})
        scores.append(lm.score_texts(docs).toPandas().sort_values("doc_id")["score"].to_numpy())
    assert found[0] == found[1] == listed
    assert found[1][1, names["rare"], names["pair"]] == 50
    assert np.allclose(*scores, atol=1e-9)


@pytest.mark.parametrize("hot, numbered", [(0, 6), (40, 200_000), (10**6, 200_000), (10**6, 0)])
def test_scores_equal_a_brute_force_tree(spark, monkeypatch, hot, numbered):
    """Training texts, so that no word is spelled; the tree broadcast not at all, partly, and whole."""
    monkeypatch.setattr(lm, "HOT_TERMS", hot)
    monkeypatch.setattr(lm, "HOT_WORDS", numbered)
    rng = np.random.default_rng(8)
    texts = [" ".join(f"v{min(int(x), 30)}" for x in np.cumsum(rng.integers(0, 3, 40)) % 31) for _ in range(60)]
    rows = spark.createDataFrame([(None, t) for t in texts], "doc_id bigint, text string")
    seqs = [["<", *t.split(), ">"] for t in texts]
    counts = Counter(w for s in seqs for w in s[1:])
    unseen = max(sum(n == 1 for w, n in counts.items()), 1) / sum(counts.values())
    own = {w: (1 - unseen) * (n + 1) / (sum(counts.values()) + len(counts)) for w, n in counts.items()}
    states, nexts = {}, defaultdict(Counter)
    for s in seqs:
        for i in range(1, len(s)):
            for k in (1, 2):
                if i >= k:
                    nexts[tuple(s[i - k : i])][s[i]] += 1

    def probability(context, w):
        if not context:
            return own[w]
        if context not in states:
            return probability(context[1:], w)
        weight, listed = states[context]
        return listed.get(w, 0) / weight + (1 - sum(listed.values()) / weight) * probability(context[1:], w)

    for context in sorted(nexts, key=len):
        listed = {w: n for w, n in nexts[context].items() if n >= lm.LEAST_PAIRS}
        total, free = sum(nexts[context].values()), len(listed)
        gain = 2 * sum(n * np.log(n / total / probability(context[1:], w)) for w, n in listed.items())
        if free and gain > free + 4 * np.sqrt(2 * free):
            states[context] = (total + free + 1, listed)
    assert {len(c) for c in states} == {1, 2}
    # The words of the texts share all but what unseen words have, after every state.
    for context in states:
        assert sum(probability(context, w) for w in counts) == pytest.approx(1 - unseen * np.prod([1 - sum(states[c][1].values()) / states[c][0] for c in (context, context[1:]) if c in states]))
    expected = [sum(np.log10(probability(tuple(s[max(0, i - 2) : i]), s[i])) for i in range(1, len(s))) for s in seqs]
    assert np.allclose(sorted(lm.score_texts(rows).toPandas()["score"]), sorted(expected))


def test_successions_are_listed_alike_at_every_size(spark):
    """The number of training tokens doesn't decide which contexts are states."""
    rows = spark.createDataFrame([(i, "first second third") for i in range(30)], "doc_id bigint, text string")
    words = lm.word_counts(rows).mapInPandas(lm._with_names, "word binary, name bigint, n bigint")
    words = words.cache()
    model = lm.fit(rows, words, 30, 10**9, 4, 60)[0]
    second = np.array([lm.name_of(b"second")]).view(np.uint64)
    third = np.array([lm.name_of(b"third")]).view(np.uint64)
    assert model.terms.find(~second)[0][0] and model.terms.find(lm._mix(second, third))[0][0]


def test_successions_travel_packed(spark, monkeypatch):
    """A task sends a row per bucket, not one per succession, and buckets add up whatever their number."""
    rng = np.random.default_rng(11)
    texts = [" ".join(f"v{i}" for i in rng.integers(0, 60, 400)) for _ in range(20)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    for numbered in (200_000, 20):
        monkeypatch.setattr(lm, "HOT_WORDS", numbered)
        shared = shared_words(spark, docs)
        found = []
        for size in (10**6, 500):
            monkeypatch.setattr(lm, "BUCKET", size)
            counts = lm.succession_counts(docs, shared, 20 * 401)
            found.append(sorted(tuple(r) for r in counts.collect()))
        assert found[0] == found[1] and len(found[0]) > 500
    ids = np.arange(10_000)
    pairs = np.stack([ids.astype(np.uint64), ids.astype(np.uint64)], axis=1)
    sent = pd.concat(lm._counted([ids, ids], [pairs], 4))
    assert len(sent) == 8 and sorted(sent["bucket"]) == [0, 0, 1, 1, 2, 2, 3, 3]
    whole = [lm.unpack(b) for b in sent["counts"]]
    assert sum(int(n.sum()) for n in whole) == 30_000 and max(len(b) for b in sent["counts"]) < 10_000


def test_few_keys_are_looked_up_in_vain(spark):
    keys = np.random.default_rng(12).integers(-(2**62), 2**62, 40_000)
    rows = pd.DataFrame({"key": keys[:20_000], "value": 1.0, "n": 5})
    terms = lm.split_terms(spark.createDataFrame(rows, "key bigint, value double, n bigint"))
    known, values, may = terms.find(keys.view(np.uint64))
    assert known[:20_000].all() and (values[:20_000] == 1).all() and not known[20_000:].any()
    assert may[20_000:].sum() < 20_000 / 30


def test_spelling_is_a_distribution(spark):
    words = spark.createDataFrame([(b"abc", 50), (b"abd", 30), (b"xyz", 25)], "word binary, n bigint")
    tree = lm.spelling_tree(words, 400)
    for context in (b"", b" ", b" a", b"ab", b"zzz"):
        state = tree.suffix(context)
        total = sum(10 ** tree.symbol_log(state, s) for s in range(lm.SYMBOLS))
        assert total == pytest.approx(1.0, abs=1e-9) or total < 1.0


# --- Mixing --------------------------------------------------------------------------


def poured(sizes, weights, cap):
    free, left = dict(enumerate(sizes)), float(sum(sizes))
    out = {}
    while free:
        share = left / sum(weights[i] for i in free)
        over = [i for i in free if weights[i] * share > cap * sizes[i]]
        if not over:
            return [out.get(i, weights[i] * share) for i in range(len(sizes))]
        for i in over:
            out[i] = cap * sizes[i]
            left -= out[i]
            del free[i]
    return [out[i] for i in range(len(sizes))]


def test_water_filling(spark):
    sizes = [1000, 10, 5, 300, 0, 70]
    weights = [1.0, 2.0, 3.0, 1.0, 2.0, 3.0]
    rows = spark.createDataFrame(list(zip("abcdef", sizes, weights)), "source string, source_size bigint, weight double")
    found = [r.target for r in mixing.water_fill(rows).orderBy("source").collect()]
    assert found == pytest.approx(poured(sizes, weights, 3.0))


def test_mix_meets_targets(spark, awkward, nothing):
    rng = np.random.default_rng(6)
    rows = [(i, str(rng.choice(["b", "a", None], p=[0.7, 0.2, 0.1])), int(rng.integers(1, 50))) for i in range(3000)]
    rows = [(i, None if s == "None" else s, n) for i, s, n in rows] + [(5000, "zero", 0)]
    sized = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint")
    out = mixing.with_repetitions(sized, sized, [1, 2, 3], ["doc_id"], seed=3).toPandas()
    assert len(out) == len(rows) and out["repeats"].max() <= 3
    order = ["a", "b", "zero", None]
    sizes = [sum(n for _, s, n in rows if s == name) for name in order]
    for name, target in zip(order, poured(sizes, [1, 2, 3, 1], 3.0)):
        mine = out[out["source"].isna() if name is None else out["source"] == name]
        assert mine["target"].iloc[0] == pytest.approx(target)
        assert abs((mine["size"] * mine["repeats"]).sum() - target) <= 50
    sized = awkward.select("doc_id", "source", F.lit(1).cast("bigint").alias("size"))
    assert mixing.with_repetitions(sized, sized, [1], ["doc_id"]).count() == len(AWKWARD)
    assert mixing.with_repetitions(sized.where("false"), sized.where("false"), [1], ["doc_id"]).count() == 0


# --- Near duplicates -----------------------------------------------------------------


def brute_components(rows, width, percent):
    sets = []
    for _, t in rows:
        w = ("" if t is None else re.sub("[A-Z]", lambda m: m[0].lower(), t)).encode().split()
        k = min(width, len(w))
        sets.append({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set())
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
            top[find(b)] = find(a)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(rows)), key=str)


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(spark, awkward, nothing, width, percent):
    extra = [(200 + i, near_copy(BASE[2], 1 + i % 9)) for i in range(60)]
    docs = spark.createDataFrame([*AWKWARD, *extra], "doc_id bigint, text string")
    found = [tuple(r) for r in dedup.near_duplicates(docs, width, percent).collect()]
    assert sorted(found, key=str) == brute_components([*AWKWARD, *extra], width, percent)
    assert dedup.near_duplicates(nothing, width, percent).count() == 0
    kept = dedup.first_of_each(awkward)
    assert kept.columns == awkward.columns
    assert kept.where("doc_id in (4, 5, 6)").count() == 1 and kept.where("doc_id = 7").count() == 2


def test_components(spark):
    edges = [(int(a), int(b)) for a, b in RNG.integers(0, 120, (90, 2))] + [(7, x) for x in range(200, 260)]
    found = {r.node: r.root for r in dedup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    groups = {x: {x} for e in edges for x in e}
    for a, b in edges:
        merged = groups[a] | groups[b]
        for x in merged:
            groups[x] = merged
    assert found == {x: min(g) for x, g in groups.items() if len(g) > 1}


def test_block_links():
    sets = [dedup.shingle_set(near_copy(BASE[1], i % 5 + 1).split(), 3) for i in range(20)]
    members = pd.DataFrame(
        {
            "node": range(20),
            "root": range(20),
            "block": 0,
            "n_shingles": [len(s) for s in sets],
            "shingles": [s.tobytes() for s in sets],
        }
    )
    found = dedup.block_links(members, 85, np.uint64)
    linked = [
        (a, b)
        for a, b in itertools.combinations(range(20), 2)
        if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))
    ]
    assert set(found) <= set(linked)
    groups = [{x} for x in range(20)]
    joined = lambda links: {frozenset(g) for g in _joined(links)}

    def _joined(links):
        of = {x: {x} for x in range(20)}
        for a, b in links:
            merged = of[a] | of[b]
            for x in merged:
                of[x] = merged
        return of.values()

    assert len(groups) == 20 and joined(found) == joined(linked)


# --- WARC ----------------------------------------------------------------------------


def in_files(spark, path):
    """What the files below a folder hold, as the audit takes it."""
    number = F.regexp_extract("path", r"pages-(-?\d+)\.warc", 1).cast("bigint").alias("file")
    return warc.read_warc(spark, path).select(number, "offset", "length", "hash", "record_id", "record").cache()


@pytest.mark.parametrize("compress", [True, False])
def test_audit_of_files(spark, folder, compress):
    rows = [(i, f"http://a/{i}", bytes([i % 256, 0xFF, 0]) * (i * 37 % 300) + b"\r\n\r\nx", "z") for i in range(600)]
    rows += [(None, None, None, None), (7, "http://a/7", rows[7][2], "z")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html binary, file string")
    records = warc.archive(pages, 200)
    assert warc.write_warc(records.repartition(5), f"{folder}/a", compress) == 4
    primary = in_files(spark, f"{folder}/a")
    assert Counter((r.file, bytes(r.record)) for r in primary.collect()) == Counter((r.file, bytes(r.record)) for r in records.collect())
    # Offsets follow from the records in order of id and hash.
    for file in (-1, 0, 1, 2):
        mine = sorted(
            (r.page_id or 0, hashlib.sha256(bytes(r.record)).digest(), len(r.record)) for r in records.where(f"file = {file}").collect()
        )
        offsets = [0, *itertools.accumulate(n + 4 for *_, n in mine)][:-1]
        assert sorted(r.offset for r in primary.where(f"file = {file}").collect()) == offsets
    assert all(r.length == len(r.record) and r.hash == hashlib.sha256(bytes(r.record)).hexdigest() for r in primary.collect())
    assert warc.audit(primary, primary).count() == 0
    assert warc.audit(primary.where("false"), primary.where("false")).count() == 0

    def change(record_id, record):
        n = int(record_id or -1)
        if n in (13, 77, 250):  # one bit: in the header, in a byte that is no text, at the end
            place = {13: 3, 77: len(record) - 6, 250: len(record) - 1}[n]
            return record[:place] + bytes([record[place] ^ 1]) + record[place + 1 :]
        if n == 333:
            return bytes(len(record))
        if n == 402:  # a length that leads nowhere
            return record.replace(b"Content-Length: ", b"Content-Length: 9")[: len(record)]
        return record

    warc.rewrite(spark, f"{folder}/a", f"{folder}/b", change)
    replica = in_files(spark, f"{folder}/b")
    at = {r.record_id: (r.file, r.offset) for r in primary.collect()}
    found = {(r.file, r.offset): r.status for r in warc.audit(primary, replica).collect()}
    assert found == {**{at[str(i)]: "damaged" for i in (13, 77, 250, 402)}, at["333"]: "missing"}
    assert {r.status for r in warc.audit(replica, primary).collect()} == {"damaged", "extra"}


def test_broken_files_lose_nothing_else(folder):
    packed = [warc.member(f"WARC/1.0\r\nContent-Length: 5\r\n\r\nbody{i}".encode() + warc.SEPARATOR) for i in range(5)]
    broken = packed[2][:20] + b"\x00\x01\x02" + packed[2][23:]
    read = lambda parts: [r for _, r in warc.cut(warc._unpacked(iter(parts)))]
    whole = read(packed)
    assert len(whole) == 5 and read([b"".join(packed)[i : i + 7] for i in range(0, 500, 7)]) == whole
    left = read([*packed[:2], broken, *packed[3:]])
    assert set(whole[:2] + whole[3:]) <= set(left)
    assert read([]) == [] and read([b"no gzip at all"]) == []
    plain = b"".join(zlib.decompress(p, 31) for p in packed)
    torn = plain[: len(plain) - 9]
    records = [r for _, r in warc.cut(iter([torn]))]
    assert records[:4] == whole[:4] and whole[4].startswith(records[4])
    assert b"".join(r + warc.SEPARATOR for _, r in warc.cut(iter([b"junk" + plain])))[4:] == plain


# --- Packing -------------------------------------------------------------------------


def test_word_ids_equal_the_tokenizer():
    encoder = packing.word_ids("word_bpe_49k.json")
    odd = ["ΑΣ Σ ς", "é <|endoftext|> x", "don't it's we'll.", "ça été ñandú, straße.", "1,2.5 a,. b..", "", "日本 語"]
    for text in [*odd, *(t or "" for _, t in AWKWARD[:12])]:
        ids = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.encode([text.encode()])[0] == np.asarray(ids, "<u4").tobytes()


def test_words_are_put_together_from_their_pieces(monkeypatch):
    """Only words with anything unusual in them cost a call of the whole tokenizer."""
    words = ["plain", "It's", "so,", "x.%%%", "Éa", "ñandú&&&", "a1b22", "straße.", "'tis", "é'", "İ.", "ß²"]
    encoder = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    expected = [encoder._whole(w.encode()) for w in words]
    asked = []
    whole = encoder._whole
    monkeypatch.setattr(encoder, "_whole", lambda text: asked.append(text) or whole(text))
    assert encoder.encode([w.encode() for w in words]) == expected
    assert {w.decode() for w in asked} == {"İ.", "ß²"}
    # With no room to keep words, the ids are the same.
    monkeypatch.setattr(packing, "CACHED_WORDS", 2)
    monkeypatch.setattr(packing, "LATE_WORDS", 2)
    encoder.clear()
    assert [encoder.encode([w.encode()])[0] for w in words * 2] == expected * 2
    assert len(encoder) <= 2 and len(encoder.late) <= 2


def test_plan_packs_the_histogram():
    rng = np.random.default_rng(9)
    for scale in (1, 40):
        lengths = Counter(int(x) for x in rng.integers(1, 129, 400))
        histogram = {n: k * scale for n, k in lengths.items()}
        plan = packing.plan_bins(histogram, capacity=128, iterations=60)
        assert all(sum(n * k for n, k in found.items()) <= 128 for found, _ in plan)
        used = Counter()
        for found, count in plan:
            for n, k in found.items():
                used[n] += k * count
        assert used == Counter(histogram)
        assert sum(c for _, c in plan) <= 1.01 * len(packing.best_fit(histogram, 128)) + 1
    assert packing.plan_bins({}) == [] and packing.plan_bins({2048: 3}) == [({2048: 1}, 3)]


def test_plan_of_one_length_with_a_third_of_many_pieces():
    """The driver's work and memory depend on the lengths, not on the number of pieces."""
    rng = np.random.default_rng(10)
    histogram = {int(n): 500_000 for n in rng.choice(np.arange(20, 900), 40, replace=False)} | {1100: 10_000_000}
    tracemalloc.start()
    plan = packing.plan_bins(histogram)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    used = Counter()
    for found, number in plan:
        assert sum(n * k for n, k in found.items()) <= 2048
        for n, k in found.items():
            used[n] += k * number
    assert used == Counter(histogram)
    assert sum(c for _, c in plan) <= sum(c for _, c in packing.best_fit_counts(histogram))
    assert peak < 20_000_000 and len(plan) < 5 * len(histogram)


def test_every_length_is_covered():
    histogram = {n: 7 for n in range(1025, 2048)}
    covered = Counter()
    for found, amount in packing.configuration_lp(histogram):
        for n, k in found.items():
            covered[n] += k * amount
    assert all(covered[n] > 7 * (1 - 1e-6) for n in histogram)


def test_pack(spark, awkward, nothing):
    out = packing.pack_documents(awkward, capacity=256).toPandas()
    assert out["doc_id"].isna().sum() == 2 and out["length"].between(1, 256).all()
    for _, bin_ in out.groupby("sequence_id"):
        places = sorted(zip(bin_["offset"], bin_["length"]))
        assert places[0][0] == 0 and sum(bin_["length"]) <= 256
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:]))
    assert (out[out["doc_id"] == 2]["length"] == 1).all()
    assert packing.pack_documents(nothing).count() == 0


# --- Fingerprints --------------------------------------------------------------------


def test_winnowing_keeps_the_rightmost_minimum(spark, awkward):
    rows = winnow.with_winnowed(
        awkward.select("text").withColumn("grams", F.lit(None)), {"kept": "text"}
    ).withColumns({"hashes": F.transform("kept", winnow.hash_of), "places": F.transform("kept", winnow.position_of)})
    every = winnow.with_winnowed(awkward.select("text"), {"kept": "text"}, window=1)
    hashes = {r.text: [x >> winnow.POSITION_BITS for x in r.kept] for r in every.collect()}
    for row in rows.collect():
        all_ = hashes[row.text]
        w = min(winnow.WINDOW, len(all_))
        kept = set()
        for i in range(len(all_) - w + 1 if all_ else 0):
            least = min(all_[i : i + w])
            kept.add(max(j for j in range(i, i + w) if all_[j] == least))
        assert row.places == sorted(kept) and row.hashes == [all_[j] for j in row.places]


def pieces(text):
    """Words of at most 16 characters, and every 16 characters in a row of longer ones."""
    found = []
    for word in re.findall(r"[^\x20\x09-\x0D]+", text):
        found += [word] if len(word) <= 16 else [word[i : i + 16] for i in range(len(word) - 15)]
    return found


def fingerprint(text):
    """(hash, position) pairs, from the definition alone."""
    crc = [zlib.crc32(p.encode()) for p in pieces(text)]
    grams = []
    for i in range(max(len(crc) - 2, 1) if crc else 0):
        value = crc[i]
        for j in (1, 2):
            value = (value * 1_000_003 + (crc[i + j] if i + j < len(crc) else 0)) % ((1 << 31) - 1)
        grams.append((xxhash.xxh64_intdigest(value.to_bytes(8, "little"), 42) >> 32) & ((1 << 31) - 1))
    kept = []
    for i in range(max(len(grams) - 3, 1) if grams else 0):
        window = range(i, min(i + 4, len(grams)))
        best = min(window, key=lambda j: (grams[j], -j))
        if (grams[best], best) not in kept:
            kept.append((grams[best], best))
    return kept


def test_compare_equals_a_plain_version(spark):
    rng = np.random.default_rng(12)
    words = [*WORDS[:40], "é日本" * 3, "q" * 16, "ab" * 12, "url/" * 9, "\t", "\n"]
    texts = [" ".join(rng.choice(words, int(rng.integers(0, 60)))) for _ in range(40)] + ["", None, "x" * 500]
    rows = [(int(i), t) for i, t in zip(rng.permutation(500), texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = {r.doc_id: r for r in winnow.compare_with_edits(docs).collect()}
    ordered = sorted((i, t or "") for i, t in rows)
    assert len(found) == len(rows)
    like = lambda a, b: 1.0 if not a and not b else 2 * len(a & b) / (len(a) + len(b))
    hashes = lambda kept: {h for h, _ in kept}
    for (i, text), (_, after) in zip(ordered, [*ordered[1:], ordered[0]]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row, own, other = found[i], fingerprint(text), fingerprint(edited)
        as_hex = lambda kept: " ".join(f"{(h << 31) + ((1 << 31) - 1 - at):X}" for h, at in kept)
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (row.fingerprint, row.edited_fingerprint) == (as_hex(own), as_hex(other))
        assert row.near_edited == pytest.approx(like(hashes(own), hashes(other)))
        assert row.near_next == pytest.approx(like(hashes(own), hashes(fingerprint(after))))


def test_passages_without_blanks_are_found_at_every_offset(spark):
    rng = np.random.default_rng(2)
    shared = "".join(chr(0x4E00 + int(c)) for c in rng.integers(0, 3000, 60))
    other = lambda n: "".join(chr(0x7000 + int(c)) for c in rng.integers(0, 3000, n))
    docs = spark.createDataFrame([(k, other(k) + shared + other(30)) for k in range(17)], "doc_id bigint, text string")
    sets = [set(x >> winnow.POSITION_BITS for x in r.kept) for r in winnow.fingerprints(docs).collect()]
    assert all(len(a & b) >= 5 for a, b in itertools.combinations(sets, 2))


def test_shared_runs_are_found(spark):
    shared = text_of(winnow.WINDOW + winnow.GRAM - 1)
    rows = [(i, f"{text_of(15)} {shared} {text_of(9)}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = [set(x >> winnow.POSITION_BITS for x in r.kept) for r in winnow.fingerprints(docs).collect()]
    assert all(a & b for a, b in itertools.combinations(sets, 2))


def test_next_documents(spark, awkward, nothing):
    rows = [(int(i), f"t{i}") for i in RNG.permutation(700) * 3]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    ids = sorted(i for i, _ in rows)
    following = {i: f"t{j // 3}" for i, j in zip(ids, [*ids[1:], ids[0]])}
    texts = dict(rows)
    found = {r.doc_id: r.next_text for r in winnow.with_next(docs).collect()}
    assert found == {i: texts[j] for i, j in zip(ids, [*ids[1:], ids[0]])} and len(following) == 700
    compared = winnow.compare_with_edits(awkward).collect()
    assert len(compared) == len(AWKWARD)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in compared)
    same = {r.fingerprint for r in compared if r.doc_id in (4, 5)}
    assert len(same) == 1
    assert winnow.compare_with_edits(nothing).count() == 0


def test_every_operator_is_registered():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries()) == list(range(1, 14))
