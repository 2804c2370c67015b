"""The training-data queries against their SQL, and against plain Python where they have none."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash

import __spark_entry__ as contract
from postlens.llm.oracles import ORACLES
from postlens.llm.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="module")
def documents(duck):
    return duck.sql("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall()


def rows(spark, sf_dir, name):
    return {r.doc_id: r for r in QUERIES[name](spark, sf_dir).collect()}


def test_all_are_registered():
    assert QUERIES.keys() <= contract.queries().keys()
    assert ORACLES.keys() <= contract.oracle_sql().keys()
    assert QUERIES.keys() - ORACLES.keys() == {
        "op3_suffix_dedup", "op5_flow_sharding", "op6_simhash", "op10_token_files", "op11_whiten", "op12_language_id",
        "pipeline",
    }


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(row[c] for c in columns)) for row in df.collect())
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert got == sorted(repr(tuple(dict(zip(names, r, strict=True))[c] for c in columns)) for r in cursor.fetchall())


def test_suffix_dedup(spark, sf_dir, documents):
    got, raws = rows(spark, sf_dir, "op3_suffix_dedup"), [(i, (t or "").encode()) for i, t, _ in documents]
    at = lambda raw, s: hashlib.blake2b(raw[s : s + 200], digest_size=12).digest()
    counts = Counter(at(raw, s) for _, raw in raws for s in range(len(raw) - 199))
    removed = 0
    for doc_id, raw in raws:
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - 199):
            if counts[at(raw, s)] > 1:
                gone[s : s + 200] = True
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        row = got[doc_id]
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        assert (row.n_bytes, row.n_removed, row.n_spans) == (len(raw), gone.sum(), spans)
        assert row.kept_sha256 == hashlib.sha256(kept).hexdigest()
        removed += row.n_removed
    assert removed and len(got) == len(raws)


def test_sharding(spark, sf_dir, documents):
    got = rows(spark, sf_dir, "op5_flow_sharding")
    sizes = [0] * 8
    for doc_id, text, _ in documents:
        row = got[doc_id]
        assert row.size == len((text or "").encode()) + 1 and row.text_crc32 == zlib.crc32((text or "").encode())
        assert row.law == "bytes" and row.grown_shard is None
        sizes[row.shard] += row.size
    for shard in range(8):
        slots = sorted(r.slot for r in got.values() if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert len(got) == len(documents)
    assert max(sizes) - min(sizes) <= max(r.size for r in got.values())


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, sf_dir, documents):
    got = rows(spark, sf_dir, "op6_simhash")
    prints = {i: plain_fingerprint(t) for i, t, _ in documents}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    for i in ids:
        assert got[i].fingerprint == f"{prints[i]:016x}" and got[i].component_id == find(i)
    assert len({r.component_id for r in got.values()}) < len(ids)


def test_token_files(spark, sf_dir, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got, start = rows(spark, sf_dir, "op10_token_files"), 0
    for doc_id, text, _ in documents:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        row = got[doc_id]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
