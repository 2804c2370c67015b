"""Ranges of offsets: blocks, overlaps, repeats, gaps, resuming."""

from __future__ import annotations

import json
import random

from postlens.sources import offsets
from postlens.streaming import jobs

MESSAGE = "topic string, partition int, offset long, value string"


def plain(rows):
    """Per partition, (first, last, messages, repeats, missing) by brute force."""
    found = {}
    for topic, partition, offset, _ in rows:
        if offset is not None:
            found.setdefault((topic, partition), []).append(offset)
    out = set()
    for key, seen in found.items():
        there = sorted(set(seen))
        starts = [o for o in there if o - 1 not in set(there)]
        for i, first in enumerate(starts):
            last = next(o for o in range(first, first + len(there)) if o + 1 not in set(there))
            n = sum(first <= o <= last for o in seen)
            out.add((*key, first, last, n, n - (last - first + 1), starts[i + 1] - last - 1 if i + 1 < len(starts) else 0))
    return out


def test_ledger_over_batches_and_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(offsets, "BLOCK", 8)
    make = random.Random(3)
    rows = [(t, p, make.randint(0, 60), "v") for t in ("a", "b") for p in range(3) for _ in range(50)]
    rows += [("a", 0, None, "v"), (None, None, 5, "v"), ("b", 1, 10_000_000_000, "v")]
    whole = offsets.ledger(offsets.ranges(spark.createDataFrame(rows, MESSAGE)))
    assert {tuple(r) for r in whole.collect()} == plain(rows)
    write = jobs.ledger_writer(str(tmp_path))
    for batch in (0, 1, 2, 1):
        write(spark.createDataFrame(rows[batch::3], MESSAGE), batch)
    assert {tuple(r) for r in jobs.read_ledger(spark, str(tmp_path)).collect()} == plain(rows)
    points = offsets.resume_points(whole)
    got = {(r.topic, r.partition): (r.safe, r.seen) for r in points.collect()}
    firsts = {}
    for topic, partition, first, last, *_ in sorted(plain(rows), key=lambda r: (str(r[0]), str(r[1]), r[2])):
        firsts.setdefault((topic, partition), last + 1)
    assert {k: v[0] for k, v in got.items()} == firsts and got["b", 1][1] == 10_000_000_001
    named = json.loads(offsets.starting_offsets(points.where("topic IS NOT NULL"), "seen"))
    assert set(named) == {"a", "b"} and named["b"]["1"] == 10_000_000_001


def test_nothing_read(spark):
    none = spark.createDataFrame([("a", 0, None, "v")], MESSAGE)
    assert offsets.ledger(offsets.ranges(none)).collect() == []
    assert offsets.starting_offsets(offsets.resume_points(offsets.ledger(offsets.ranges(none)))) == "{}"
