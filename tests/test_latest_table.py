"""The maintained table of latest rows: levels, replays, failures, look-ups."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import AnalysisException

from postlens.streaming.latest_table import DELTA, MERGED, SNAPSHOT, LatestTable

ROW = "id long, at long, text string, _k string"


def batches(n, seed=1, rows=20):
    make = random.Random(seed)
    return [[(make.choice([None, *range(40)]), make.randint(0, 9), f"{b}.{i}", "x") for i in range(rows)] for b in range(n)]


def latest(given):
    """By brute force; of equal order the later batch counts, within one batch any."""
    found = {}
    for b, rows in enumerate(given):
        for key, at, text, _ in rows:
            held = found.setdefault(key, (at, b, set()))
            if (at, b) > held[:2]:
                found[key] = (at, b, {text})
            elif (at, b) == held[:2]:
                held[2].add(text)
    return found


def test_reads_stay_bounded_and_replays_change_nothing(spark, tmp_path):
    table = LatestTable(spark, str(tmp_path), "id", ["at"], buckets=4, fan=2)
    assert table.read() is None and table.state() == (0, []) and table.unnamed() == []
    given = batches(7)
    for b, rows in enumerate(given):
        table.apply(spark.createDataFrame(rows, ROW), b)
        levels = [r.level for r in table.state()[1]]
        assert levels.count(DELTA) < 2 and levels.count(MERGED) < 2 and levels.count(SNAPSHOT) <= 1
    wanted = latest(given)

    def check():
        rows = table.read().collect()
        assert len(rows) == len(wanted)
        for r in rows:
            assert r.at == wanted[r.id][0] and r.text in wanted[r.id][2]
        return sorted(map(repr, rows))

    before = check()
    for b in (6, 2):
        table.apply(spark.createDataFrame(given[b], ROW), b)
    assert [s.split("text=")[1].split(".")[0] for s in check()] == [s.split("text=")[1].split(".")[0] for s in before]
    assert table.read().columns == ["id", "at", "text", "_k"]
    some = {r.id: r for r in table.read([3, None, 99]).collect()}
    assert set(some) == {3, None} & set(wanted) and table.read([]).count() == 0
    assert table.unnamed()


def test_what_fails_half_way_is_not_named(spark, tmp_path, monkeypatch):
    table = LatestTable(spark, str(tmp_path), "id", ["at"], buckets=2, fan=8)
    given = batches(2, rows=5)
    table.apply(spark.createDataFrame(given[0], ROW), 0)
    state = table.state()
    monkeypatch.setattr(table, "state", lambda: (state[0] - 1, []))
    with pytest.raises(AnalysisException):
        table.apply(spark.createDataFrame(given[1], ROW), 1)
    monkeypatch.undo()
    assert table.state() == state and len(table.unnamed()) == 1
    table.apply(spark.createDataFrame([], ROW), 1)
    assert table.state() == state
    table.apply(spark.createDataFrame(given[1], ROW).drop("text"), 2)
    assert set(table.read().columns) == {"id", "at", "text", "_k"}
