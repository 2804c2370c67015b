"""Each stage of the pipeline on its own input, against SQL or plain Python; then the whole."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from postlens.llm.oracles import ORACLES
from postlens.session import written


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Input and output rows of each stage."""
    docs, found = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, sf_dir), "stage")
        found[name] = ([r.asDict() for r in docs.collect()], [r.asDict() for r in after.collect()])
        docs = after
    return found


def sql(sf_dir, statement, documents):
    import pyarrow as pa

    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        if path.stem != "documents":
            connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    connection.register("documents", pa.Table.from_pylist(documents))
    cursor = connection.execute(statement)
    names = [d[0] for d in cursor.description]
    return [dict(zip(names, row, strict=True)) for row in cursor.fetchall()]


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "SimHash near-dedup", "benchmark decontamination", "mixing to target weights", "sharding",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality(stages, sf_dir):
    before, after = stages["quality rules"]
    verdicts = sql(sf_dir, ORACLES["op2_quality_rules"], before)
    assert ids(after) == ids(v for v in verdicts if v["kept"]) and len(after) < len(before)
    assert set(before[0]) == set(after[0])


def test_near_dedup(stages):
    before, after = stages["SimHash near-dedup"]
    shingles = {}
    for row in before:
        words = row["text"].encode().lower().split()
        shingles[row["doc_id"]] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    kept = set(ids(after))
    alike = lambda a, b: len(shingles[a] & shingles[b]) / len(shingles[a] | shingles[b])
    root = {i: i for i in shingles}
    for a in sorted(shingles):
        for b in shingles:
            if a < b and alike(a, b) >= 0.8 and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    assert len(kept) == len(after) < len(before)
    assert kept == set(root.values())


def test_decontamination(stages, sf_dir):
    before, after = stages["benchmark decontamination"]
    verdicts = sql(sf_dir, ORACLES["op9_decontaminate"], before)
    assert ids(after) == ids(v for v in verdicts if not v["contaminated"]) and len(after) < len(before)


def test_mixing(stages, sf_dir):
    before, after = stages["mixing to target weights"]
    wanted = {v["doc_id"]: v["taken"] // v["size"] for v in sql(sf_dir, ORACLES["op7_mix_sources"], before) if v["size"]}
    assert Counter(ids(after)) == Counter({i: n for i, n in wanted.items() if n})
    assert set(before[0]) == set(after[0])


def test_sharding(stages):
    before, after = stages["sharding"]
    assert ids(before) == ids(after)
    sizes = Counter()
    for row in after:
        sizes[row["shard"]] += len(row["text"].encode()) + 1
    largest = max(len(r["text"].encode()) + 1 for r in after)
    assert set(sizes) <= set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 3 * largest


def test_run_is_the_stages(spark, sf_dir, stages):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert ids(r.asDict() for r in rows.collect()) == ids(stages["sharding"][1])
    assert {"doc_id", "text", "lang", "source", "n_chars", "shard"} <= set(rows.columns)
