"""Spelling correction against brute force on small vocabularies."""

from __future__ import annotations

import random

import pytest

from postlens.operators import spelling

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def one_edit(word: str) -> set[str]:
    out = set()
    for i in range(len(word) + 1):
        head, tail = word[:i], word[i:]
        out |= {head + c + tail for c in LETTERS}
        if tail:
            out.add(head + tail[1:])
            out |= {head + c + tail[1:] for c in LETTERS}
        if len(tail) > 1:
            out.add(head + tail[1] + tail[0] + tail[2:])
    return out


def brute(word: str, counts: dict[str, int]) -> str:
    if word in counts:
        return word
    once = one_edit(word)
    near = once & counts.keys()
    if not near:
        near = {c for c in counts if abs(len(c) - len(word)) <= 2 and (one_edit_back(c, once))}
    return min(near, key=lambda c: (-counts[c], c)) if near else word


def one_edit_back(candidate: str, once: set[str]) -> bool:
    return any(abs(len(m) - len(candidate)) <= 1 and candidate in one_edit(m) for m in once)


def check(spark, counts: dict[str, int], words: set[str]) -> None:
    known = spark.createDataFrame(list(counts.items()), "word STRING, count BIGINT")
    asked = spark.createDataFrame([(w,) for w in words], "word STRING")
    got = {r.word: r.correction for r in spelling.correct_words(asked, known).collect()}
    assert got == {w: brute(w, counts) for w in words}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_words(spark, seed):
    rng = random.Random(seed)
    counts = {}
    for _ in range(60):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 6)))
        counts[word] = rng.randint(1, 4)
    words = {"".join(rng.choice("abcde") for _ in range(rng.randint(1, 7))) for _ in range(40)}
    check(spark, counts, words)


def test_kinds_of_edits_and_ties(spark):
    counts = {"makan": 5, "malam": 5, "minum": 9, "abc": 2, "tidak": 7, "tidur": 7, "ke": 3}
    words = {"makn", "mkaan", "maksn", "makaan", "mlam", "ca", "tidk", "tiduk", "zzzzzz", "minum", "k", "e", "x"}
    check(spark, counts, words)


def test_characters_an_edit_cannot_put_in(spark):
    counts = {"abc1": 3, "café": 4, "a_b": 2, "1abc": 5, "12": 9, "naïve": 1}
    words = {"abc", "1abx", "cafe", "caf", "ab", "a_c", "abc12", "1", "naive", "naïv", "éabc", "bac1", "abc1é"}
    check(spark, counts, words)


def test_very_short_words_share_one_candidate(spark):
    counts = {"ke": 3, "di": 3, "ya": 1, "o": 2, "é1": 50, "甲": 60, "甲乙": 70, "abc": 90}
    check(spark, counts, {"xx", "x", "zz", "1x", "乙", "乙甲", "丙丁", "é", "qz", "x甲", "k", "oo"})


def test_hot_repeats_of_one_unknown_word(spark):
    known = spark.createDataFrame([("makan", 5), ("minum", 4)], "word STRING, count BIGINT")
    asked = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'mkan' ELSE concat('q', id) END AS word")
    got = spelling.correct_words(asked, known)
    assert got.where("word = 'mkan'").collect() == [("mkan", "makan")]
    assert got.count() == 20_001


def test_long_words_use_segments(spark):
    base = "perpustakaannasionalindonesia"
    counts = {base: 3, base + "raya": 2, base[:19]: 4, base[:21] + "zz": 1}
    variants = {
        base[1:], base[:-1], base[:10] + base[11:], base[:5] + "x" + base[5:], base[:12] + "qq" + base[14:],
        base[:7] + base[8] + base[7] + base[9:], "zz" + base, base + "yy", base[2:], base[:18], base[:20], base[:22],
        base[:21], base[:3] + base[4] + base[3] + base[5:20] + base[21] + base[20] + base[22:],
    }
    check(spark, counts, variants)
