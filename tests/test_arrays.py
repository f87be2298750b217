"""JSON arrays cut anywhere, against the reader that takes each file whole."""

import json
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from courierlake.session import setting
from courierlake.sources import arrays, raw
from courierlake.sources.schemas import CORRUPT, RAW_TABLES

EVENTS = RAW_TABLES["delivery_events"]


def objects(n, seed):
    """Events whose texts hold braces, quotes and backslashes."""
    rng = random.Random(seed)
    odd = ["}", "{", '"', "\\", "},{", "]", "[", "é日本", "\n", "\\\\", '\\"}', "x" * 200, "}" * 9, "{" * 9]
    return [
        {
            "order_id": "".join(rng.choices(odd, k=rng.randrange(6))),
            "rider_id": None if rng.random() < 0.3 else str(i),
            "event_type": "delivered",
            "event_ts": "2026-01-15T10:00:00",
            "latitude": i / 4,
            "longitude": 2.0,
        }
        for i in range(n)
    ]


@pytest.mark.parametrize("size", [400, 2500, 1 << 20])
def test_equals_the_whole_file_reader(spark, folder, size):
    rows = objects(40, size)
    rows[20]["more"] = {"deep": {"er": [1, {"x": "}"}]}}
    Path(folder, "a.json").write_text(json.dumps(rows))
    Path(folder, "b.json").write_text(json.dumps(rows[:20], indent=3, ensure_ascii=False))
    Path(folder, "c.json").write_text("[]")
    Path(folder, "d.json").write_text(json.dumps({**rows[0], "latitude": "north"}))
    with setting(spark, "spark.sql.files.maxPartitionBytes", str(size)), setting(spark, "spark.sql.files.openCostInBytes", "1"):
        split = raw.read_json_arrays(spark, folder, EVENTS)
        tasks = arrays._pieces(spark, folder).rdd.getNumPartitions()
        rows = split.collect()
    found = sorted(str(r[:-1]) for r in rows)
    files = Counter(r._source_file.rsplit("/", 1)[1] for r in rows)
    whole = raw.read_json(spark, folder, EVENTS, lines=False)
    assert found == sorted(str(r[:]) for r in whole.collect())
    assert files == {"a.json": 40, "b.json": 20, "d.json": 1}
    assert tasks > 12 or size > 1000


def test_what_is_no_array(spark, folder):
    texts = {"a": '[{"order_id": "o1"}, {"order_id": "o2"', "b": "no json", "c": '[1, {"order_id": "o3"}] x', "d": ""}
    for name, text in texts.items():
        Path(folder, f"{name}.json").write_text(text)
    for size in ("10", "100000"):
        with setting(spark, "spark.sql.files.maxPartitionBytes", size):
            rows = raw.read_json_arrays(spark, folder, EVENTS).select("order_id", CORRUPT).collect()
        assert sorted(r.order_id for r in rows if r[CORRUPT] is None) == ["o1"]
        assert sorted(r[CORRUPT] for r in rows if r[CORRUPT]) == ['1, {"order_id": "o3"}', "no json", "x", '{"order_id": "o2"']


def test_states_of_pieces():
    assert arrays.after('[{"a": "b', (False, 0)) == (True, 1)
    assert arrays.after('c", "d": {', (True, 1)) == (False, 2)
    assert arrays.after('still "{', (True, 1)) == (False, 2)
    assert arrays.after('\\"still', (True, 1)) == (True, 1)
    assert arrays.closed((True, 1)) == (True, 1) and arrays.closed((False, 1)) == (False, 0)


def test_small_ranges_share_tasks(spark, folder):
    for i in range(60):
        Path(folder, f"{i}.json").write_text(json.dumps(objects(10, i)))
    with setting(spark, "spark.sql.files.maxPartitionBytes", "300"), setting(spark, "spark.sql.files.openCostInBytes", "1"):
        tasks = arrays._pieces(spark, folder).rdd.getNumPartitions()
        parts = arrays.array_objects(spark, folder)
        assert tasks == arrays.TASKS_PER_CORE * spark.sparkContext.defaultParallelism < 60
        assert parts.count() == 600
