"""The near-copy stage of the pipeline against brute force over all pairs of shingle sets."""

from __future__ import annotations

import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parents[2])]

import corpus_pipeline  # noqa: E402
from cohort.llm import near_copies as near  # noqa: E402
from cohort.llm import shared  # noqa: E402
from cohort.llm.exact_dedup import drop_copies  # noqa: E402
from cohort.plans.workspace import shared_folder  # noqa: E402

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, words=5):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    return frozenset(" ".join(found[k : k + words]) for k in range(max(1, len(found) - words + 1)) if found)


def brute_groups(texts, threshold=0.8):
    """For each text the place of the first text of its component."""
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] == sets[b] or common * (1 + threshold) >= threshold * (len(sets[a]) + len(sets[b])) - 1e-9:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return root


def same_parts(got, want):
    """Whether two lists of labels part the places alike."""
    return len(set(zip(got, want))) == len(set(got)) == len(set(want))


def made_texts(rng):
    """Edits of all strengths, a dense group, a passage in many texts, odd texts."""
    vocabulary = [f"w{k}" for k in range(400)]
    texts = []
    for k in range(40):
        base = rng.choice(vocabulary, int(rng.integers(3, 120))).tolist()
        texts.append(base)
        for _ in range(3):
            other = list(base)
            for at in rng.integers(0, len(base), int(rng.integers(0, max(2, len(base) // 25)))):
                other[at] = rng.choice(vocabulary)
            texts.append(other)
    base = rng.choice(vocabulary, 150).tolist()
    for _ in range(60):
        other = list(base)
        other[int(rng.integers(0, 150))] = rng.choice(vocabulary)
        texts.append(other)
    passage = rng.choice(vocabulary, 40).tolist()
    texts += [rng.choice(vocabulary, int(n)).tolist() + passage for n in rng.integers(0, 60, 40)]
    return [" ".join(t) for t in texts] + ["", None, " \n", "One two", "one  TWO", "three"]


@pytest.mark.parametrize("block, agree", [(2_000, 4), (10, 4), (10, 99)])
def test_all_links_are_found(spark, monkeypatch, block, agree):
    # 99: no first components, so the join alone must find everything.
    monkeypatch.setattr(near, "AGREE", agree)
    texts = made_texts(np.random.default_rng(8))
    df = spark.createDataFrame(list(enumerate(texts)), "place long, text string")
    got = {r.place: bytes(r.near_group) for r in near.near_copies(df, block=block).collect()}
    assert same_parts([got[k] for k in range(len(texts))], brute_groups(texts))
    assert near.near_copies(df.filter("false")).count() == 0


def test_stage_links_by_shingles(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = docs.collect()
    root = brute_groups([r.text for r in rows])
    least = {}
    for r, g in zip(rows, root):
        least[g] = min(least.get(g, r.doc_id), r.doc_id)
    got = Counter(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, folder).collect())
    assert got == Counter(least.values())


def test_stage_with_null_and_repeated_ids(spark):
    long = " ".join(f"a{k}" for k in range(60))
    other = " ".join(f"b{k}" for k in range(60))
    rows = [(None, long), (None, long + " x"), (None, other), (7, other + " y"), (7, "alone here"), (7, "alone here"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_near_copies(spark, df, "").collect()
    assert Counter(r.doc_id for r in kept) == {7: 2, None: 2}
    assert {r.text for r in kept if r.doc_id == 7} == {other + " y", "alone here"}
    assert sum(r.text in (long, long + " x") for r in kept) == 1


def test_columns_of_any_name(spark):
    text = " ".join(f"a{k}" for k in range(60))
    rows = [(1, text, 5, "k", 1, 2, 3), (2, text + " x", 5, "k", 1, 2, 3), (3, "other", 6, "l", 1, 2, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, key string, least int, near_group int, me long")
    kept = corpus_pipeline.drop_near_copies(spark, df, "").collect()
    assert sorted(map(tuple, kept)) == [rows[0], rows[2]]
    groups = {r.doc_id: bytes(r.near_group) for r in near.near_copies(df).collect()}
    assert groups[1] == groups[2] != groups[3]


def test_rows_that_repeat_id_and_text(spark, monkeypatch):
    text = " ".join(f"a{k}" for k in range(60))
    df = spark.createDataFrame([(7, text, k) for k in range(3)] + [(8, text + " y", 3)], "doc_id long, text string, k int")
    for most in (shared.BROADCAST_BYTES, 0):
        monkeypatch.setattr(shared, "BROADCAST_BYTES", most)
        kept = corpus_pipeline.drop_near_copies(spark, df, "").collect()
        assert [(r.doc_id, r.text) for r in kept] == [(7, text)]
    assert corpus_pipeline.drop_near_copies(spark, df.filter("false"), "").count() == 0


def test_drop_copies(spark, monkeypatch):
    rows = [(1, "Aa b"), (3, "aa B"), (3, "aa B"), (None, "aa b"), (None, "x"), (None, "X"), (2, None), (5, ""), (4, "É"), (4, "é")]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, own int")
    for most in (shared.BROADCAST_BYTES, 0):
        monkeypatch.setattr(shared, "BROADCAST_BYTES", most)
        kept = drop_copies(df)
        assert kept.columns == df.columns
        found = sorted((r.doc_id or 0, (r.text or "").lower()) for r in kept.collect())
        assert found == [(0, "x"), (3, "aa b"), (4, "é"), (4, "é"), (5, "")]
        assert drop_copies(df.filter("false")).count() == 0


def test_stage_takes_links_of_fingerprints(spark, monkeypatch):
    # 99: MinHash gives none.
    monkeypatch.setattr(near, "AGREE", 99)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"]), " ".join(f"v{k}" for k in range(400))]
    prints = [near.majority(near.shingles(t.encode()).astype(">u8").view(np.uint8).reshape(-1, 8)) for t in texts]
    assert (prints[0] ^ prints[1]).bit_count() <= near.BITS < (prints[0] ^ prints[2]).bit_count()
    asked = []
    monkeypatch.setattr(near, "verified", lambda *a, of=near.verified: asked.append(a[0].count()) or of(*a))
    joined = []
    monkeypatch.setattr(near, "candidates", lambda *a, of=near.candidates: joined.append(of(*a)) or joined[-1])
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()) == [0, 2]
    # The fingerprints' pair is verified; nothing is left to the join.
    assert asked[0] == 1 and sum(asked[1:]) == 0


def test_sketches_lose_no_link():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 2_000))
        own = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        other = own[rng.random(len(own)) < rng.uniform(0.7, 1)]
        other = np.unique(np.append(other, rng.integers(0, 1 << 63, int(rng.integers(0, 1 + n // 4)), dtype=np.uint64)))
        apart = int.from_bytes(near.sketch(own)) ^ int.from_bytes(near.sketch(other))
        assert apart.bit_count() <= len(np.setxor1d(own, other))


def test_long_sketches_lose_no_link():
    rng = np.random.default_rng(4)
    for n in [1, 255, 256, 257, 511, 1_024, 1_025, *rng.integers(1, 5_000, 200).tolist()]:
        own = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        other = own[rng.random(len(own)) < rng.uniform(0.4, 1)]
        other = np.unique(np.append(other, rng.integers(0, 1 << 63, int(rng.integers(0, 1 + n // 2)), dtype=np.uint64)))
        one, two = near.long_sketch(own), near.long_sketch(other)
        assert near.apart(one, two) == near.apart(two, one) <= len(np.setxor1d(own, other))
        assert len(own) <= max(256, 8 * len(one)) and 8 * len(one) <= max(256, 2 * len(own))
        assert near.apart(one, near.sketch(own)) == 0


def test_long_texts_that_are_no_near_copies_do_not_travel(spark, monkeypatch):
    """Texts too long for short sketches that share over half their shingles are told apart by long ones."""
    rng = np.random.default_rng(6)
    pair = [[f"w{k}" for k in rng.integers(0, 1 << 40, 1_500)] for _ in range(8)]
    texts = [" ".join(p) for p in pair]
    texts += [" ".join(p[:900] + [f"v{k}" for k in rng.integers(0, 1 << 40, 600)]) for p in pair]
    texts[9] = " ".join(pair[1][:-20])  # one link
    asked = []
    monkeypatch.setattr(near, "verified", lambda *a, of=near.verified: asked.append(a[0].count()) or of(*a))
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    kept = corpus_pipeline.drop_near_copies(spark, df.repartition(4, "doc_id"), "").collect()
    assert sorted(r.doc_id for r in kept) == [k for k in range(16) if k != 9]
    assert sum(asked) == 1


def test_rows_of_a_crowded_shingle_meet_once(spark):
    rows = [(1, f"k{k}", "one") for k in range(5)]  # one component: nothing to find
    rows += [(2, f"k{k}", f"f{k % 3}") for k in range(9)] + [(3, "k0", "f0"), (3, "k1", "f1")]
    df = spark.createDataFrame(rows, "token long, key string, first string")
    for block in (2, 4, 100):
        met = near.in_blocks(near.materialize(df, "rows"), block).collect()
        groups = {}
        for r in met:
            groups.setdefault((r.token, r.pair), []).append(r)
        pairs = Counter(
            (token, *sorted((x.key, y.key)))
            for (token, _), own in groups.items()
            for i, x in enumerate(own)
            for y in own[:i]
            if x.alone or x.mine != y.mine
        )
        want = {(t, *sorted((x, y))) for t, x, _ in rows for u, y, _ in rows if t == u and x < y}
        assert set(pairs.values()) == {1}
        assert {p for p in pairs if block > 5 or p[0] > 1} == {p for p in want if block > 5 or p[0] > 1}
        assert block > 4 or not any(r.token == 1 for r in met)


def test_texts_are_deleted_once_they_are_compared(spark, monkeypatch):
    texts = [" ".join(f"a{k}" for k in range(60)) + end for end in ("", " x", " y z")]
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before, left = set(folder.iterdir()), []
    monkeypatch.setattr(near, "components", lambda edges, of=near.components: left.extend(folder.iterdir()) or of(edges))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()] == [0]
    names = {p.name.removeprefix("cohort-").rpartition("-")[0] for p in set(left) - before}
    assert "near-links" in names and not names & {"wanted", "wanted-texts", "set-fingerprints", "minhash-groups"}


def test_a_dense_group_is_not_paired_with_itself(spark, monkeypatch):
    """Texts that share frequent passages but are no near copies make few pairs."""
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(150)]
    texts = []
    for _ in range(200):
        other = list(base)
        for at in rng.integers(0, 150, 3):
            other[at] = f"x{rng.integers(0, 1 << 40)}"
        texts.append(" ".join(other))
    made = []
    monkeypatch.setattr(near, "best_pairs", lambda pairs, of=near.best_pairs: made.append(pairs.count()) or of(pairs))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: bytes(r.near_group) for r in near.near_copies(df).collect()}
    assert same_parts([got[k] for k in range(len(texts))], brute_groups(texts))
    assert made[0] < 2_000


def own_mb():
    """MB of this process, without mapped files."""
    found = re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())
    return sum(map(int, found)) / 1024


def test_worker_gives_memory_back(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one text")], "doc_id long, text string")
    steps = []
    with monkeypatch.context() as patch:
        patch.setattr(near, "materialize", lambda df, label: df)
        given = type(docs).mapInArrow
        patch.setattr(type(docs), "mapInArrow", lambda df, step, kind: (steps.append(step), given(df, step, kind))[1])
        near.sets_of(docs, "doc_id", "text", 5)

    def batches():
        rng = np.random.default_rng(3)
        for k in range(2):
            texts = [" ".join(map(str, rng.integers(0, 1 << 40, 250))) for _ in range(5_000)]
            own = pa.array(range(k * 5_000, k * 5_000 + 5_000), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [own, own, own, pa.array(map(str, range(5_000))), pa.array(texts).cast(pa.binary())],
                names=["me", "me2", "id", "digest", "text"],
            )

    before = own_mb()
    assert sum(found.num_rows for found in steps[0](batches())) >= 10_000
    assert own_mb() - before < 25
