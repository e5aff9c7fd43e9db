"""Phrase collocations against brute force: shard sizes, odd tables, exact scores."""

from __future__ import annotations

import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parents[2])]

from cohort.llm import collocations as col  # noqa: E402
from cohort.llm import shared  # noqa: E402

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, support, most=5, top=2_000, cover=100):
    counts, n = {}, Counter()
    for text, lang in rows:
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, most + 1):
                own.update(" ".join(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        found = {p: a for p, a in own.items() if a >= support and " " in p}
        longer = {}
        for p, a in found.items():
            words = p.split(" ")
            for m in range(2, len(words)):
                for s in range(len(words) - m + 1):
                    inner = " ".join(words[s : s + m])
                    longer[inner] = max(longer.get(inner, 0), a)
        scored = []
        for p, a in found.items():
            if cover * longer.get(p, -1) >= 100 * a:
                continue
            words = p.split(" ")
            cuts = []
            for k in range(1, len(words)):
                left, right = own[" ".join(words[:k])], own[" ".join(words[k:])]
                cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            scored.append((p, a, left, right, n[lang], score))
        scored.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, k + 1, *x) for k, x in enumerate(scored[:top])]
    return sorted(out)


def made(rng):
    vocabulary = [f"W{k}" for k in range(12)] + ["é", "Ünï", "a\x1cb", " ", "x y"]
    rows = []
    for k in range(120):
        words = rng.choice(vocabulary, int(rng.integers(0, 60))).tolist()
        gaps = rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", " ; ", "?!"], len(words), p=[0.7, 0.05, 0.05] + [0.2 / 7] * 7)
        rows.append(("".join(w + g for w, g in zip(words, gaps)), rng.choice(["en", "de", None])))
    rows += [("lorem ipsum dolor sit amet " * 4, "en")] * 9 + [("la la la la la la", "fr")] * 5
    return rows + [(None, "en"), ("", None), (" \t ", "de"), (".,;", "xx"), ("word " * 3_000, "long")]


@pytest.mark.parametrize("unit_bytes, support", [(24_000_000, 6), (500, 6), (1, 3), (2_000, 15)])
def test_against_brute_force(spark, monkeypatch, unit_bytes, support):
    monkeypatch.setattr(col, "RANKED", 20)
    rows = made(np.random.default_rng(5))
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, n int, phrase string")
    for df_ in (df, df.repartition(5)):
        got = col.collocations(df_, support=support, unit_bytes=unit_bytes).collect()
        assert sorted(map(tuple, got)) == brute(rows, support)


def test_parameters(spark):
    rows = made(np.random.default_rng(6))
    df = spark.createDataFrame(rows, "text string, lang string")
    got = col.collocations(df, support=4, words=3, top=7, cover=60).collect()
    assert sorted(map(tuple, got)) == brute(rows, 4, 3, 7, 60)


def test_empty_and_rare(spark):
    df = spark.createDataFrame([("a b c", "en")], "text string, lang string")
    assert col.collocations(df.filter("false")).count() == 0
    assert col.collocations(df).count() == 0


def test_unknown_languages_are_mined_at_support_one(spark, monkeypatch):
    monkeypatch.setattr(col, "LANGUAGES", 1)
    rows = made(np.random.default_rng(7))
    df = spark.createDataFrame(rows, "text string, lang string")
    got = col.collocations(df, support=5, unit_bytes=700).collect()
    assert sorted(map(tuple, got)) == brute(rows, 5)


def test_full_filter_keeps_counts_exact(spark, monkeypatch):
    monkeypatch.setattr(shared, "MOST_BITS", 1 << 7)
    rows = made(np.random.default_rng(8))
    df = spark.createDataFrame(rows, "text string, lang string")
    got = col.collocations(df, support=5, unit_bytes=700).collect()
    assert sorted(map(tuple, got)) == brute(rows, 5)


def test_scores_pass_64_bits(spark):
    large = 10**14
    counts = spark.createDataFrame(
        [("en", "a", 1, 3 * large), ("en", "b", 1, 7 * large), ("en", "a b", 2, 2 * large)],
        "lang string, phrase string, k int, n long",
    )
    totals = spark.createDataFrame([("en", 9 * large)], "lang string, n long")
    (row,) = col.weakest_cuts(counts, totals).collect()
    assert row.score == 1000 * 2 * large * 9 * large // (21 * large * large)
