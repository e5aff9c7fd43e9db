"""Operators for training text against brute force, on small and on odd tables."""

from __future__ import annotations

import hashlib
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import xxhash

sys.path[:0] = [str(Path(__file__).resolve().parents[k]) for k in (0, 1, 2)]

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from compare import connect, difference  # noqa: E402
from test_near_copies import brute_groups  # noqa: E402
from cohort.llm import embedding_dedup as emb  # noqa: E402
from cohort.llm import queries, repeats, simhash  # noqa: E402
from cohort.llm.components import components  # noqa: E402
from cohort.llm.exact_dedup import exact_dedup, merge_runs, digest_runs  # noqa: E402
from cohort.llm.language_id import identify_language  # noqa: E402
from cohort.llm.license_scan import license_scan, make_templates, matching_blocks, order_words  # noqa: E402
from cohort.llm.line_dedup import line_dedup  # noqa: E402
from cohort.llm.mixing import mix_sources, poisson_steps  # noqa: E402
from cohort.llm.packing import WordEncoder, best_fit_plan, pack_documents, packed_sequences, tokenizer_text  # noqa: E402
from cohort.llm.quality import classify_quality  # noqa: E402

SMALL = "/root/testdata/sf0.001"
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "a line that is longer than twenty\n" * 3 + "word " * 3000 + "ende"
ODD = [
    (1, "Same Text here, longer than twenty", "en", "a"), (2, "same text HERE, longer than twenty", "en", "b"),
    (3, "same text here, longer than twenty", None, None), (3, "same text here, longer than twenty", None, None),
    (4, None, "en", "a"), (5, "", "de", "a"), (None, "no id é É ñ", "de", "a"), (None, None, None, None),
    (6, LONG, "de", "a"), (7, LONG, "de", "b"), (8, "\n\n \t\n", "en", "a"), (9, "12 34 !!", "en", "a"),
    (10, "Under the MIT-License. x cc by\nNC apache license, version 2.0", "en", "a"),
    (11, "\x1c İ ẖ ẖ <|endoftext|> it's Σας", "fr", "c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    # Names of the operators' own columns must not matter.
    return spark.createDataFrame(
        [(*r, 1, "x", 2) for r in ODD],
        "doc_id long, text string, lang string, source string, component_id int, digest string, score int",
    )


@pytest.fixture(scope="module")
def empty(odd):
    return odd.filter("false")


def frame(spark, name="documents"):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def least_reachable(pairs, nodes):
    near = defaultdict(set)
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    found = {}
    for n in sorted(nodes):
        todo = [] if n in found else [n]
        while todo:
            x = todo.pop()
            if x not in found:
                found[x] = n
                todo += near[x]
    return found


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    ours = queries.QUERIES[name](spark, SMALL).toPandas()
    assert difference(ours, connect(SMALL).sql(queries.ORACLES[name]).df()) is None


def test_entry_registers_all():
    assert {f"op{n}_" for n in range(1, 14)} == {re.match(r"op\d+_", q)[0] for q in queries.QUERIES}
    assert "pipeline" in entry.queries() and set(queries.QUERIES) <= set(entry.queries())


def test_exact_dedup_odd(odd, empty):
    rows = exact_dedup(odd, fan=2).collect()
    assert len(rows) == len(ODD)
    want = defaultdict(list)
    for i, text, *_ in ODD:
        want[(text or "").translate(ASCII)].append(i)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in want.items()}
    for r in rows:
        ids = by_sha[r.text_sha256]
        keep = max((i for i in ids if i is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(ids), r.doc_id == keep)
    assert exact_dedup(empty).count() == 0
    assert {r.keep_id for r in exact_dedup(odd, keep="smallest").filter("doc_id = 2").collect()} == {1}


def test_exact_dedup_detects_false_digest(odd):
    from pyspark.sql import functions as F

    runs = digest_runs(odd).withColumn("digest", F.lit(b"same"))
    with pytest.raises(Exception, match="share a SHA-256"):
        merge_runs(runs, 1).collect()


def test_line_dedup_odd(odd, empty):
    rows = line_dedup(odd).collect()
    assert len(rows) == len(ODD) and line_dedup(empty).count() == 0
    assert sorted((r.n_lines, r.n_dropped) for r in rows if r.doc_id in (1, 2, 3)) == [(1, 0), (1, 0), (1, 1), (1, 1)]
    assert {r.text for r in rows if r.doc_id == 3} == {ODD[2][1]}
    three = line_dedup(odd, min_docs=2).collect()
    assert [(r.n_dropped, r.text) for r in three if r.doc_id == 6] == [(4, "")]
    assert [r.runs[0]["length"] for r in three if r.doc_id == 6] == [4]
    assert [(r.n_lines, r.text) for r in rows if r.doc_id == 4] == [(1, "")]


def test_mixing(spark, odd, empty):
    rows = mix_sources(odd).collect()
    assert all(0 <= r.mix_copy < r.mix_repeats for r in rows) and mix_sources(empty).count() == 0
    copies = Counter((r.doc_id, r.text) for r in rows if r.doc_id not in (None, 3))
    assert all(copies[r.doc_id, r.text] == r.mix_repeats for r in rows if r.doc_id not in (None, 3))
    docs = frame(spark)
    wanted = {"src0": 1.0, "src1": 3.0}
    size = Counter()
    for r in mix_sources(docs, weights=wanted).collect():
        size[r.source] += len(r.text.encode()) + 1
    assert set(size) <= set(wanted) and size["src1"] > size["src0"]
    with pytest.raises(ValueError):
        mix_sources(docs, weights={"nowhere": 1.0})
    with pytest.raises(ValueError):
        mix_sources(docs.withColumnRenamed("lang", "mix_key"))


@pytest.mark.parametrize("rate", [0.3, 7.0, 180.0, 250.0, 1e6])
def test_poisson_steps(spark, rate):
    import math

    (row,) = poisson_steps(spark.createDataFrame([("a", rate)], "mix_source string, mix_rate double")).collect()
    k = np.arange(row.mix_first, row.mix_first + len(row.mix_steps))
    terms = np.exp([x * math.log(rate) - rate - math.lgamma(x + 1) for x in k.tolist()])
    assert np.allclose(row.mix_steps, np.cumsum(terms), atol=1e-7) and row.mix_steps[-1] == pytest.approx(1, abs=1e-7)
    assert len(k) <= 24 * rate**0.5 + 70


def test_mixing_rows_without_ids_are_spread(spark):
    rows = [(None, f"text {k}", "a") for k in range(2_000)] + [(None, None, "a"), (None, "", "a"), (5, "x " * 40_000, "b")]
    out = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).filter("doc_id is null")
    repeats = {r.text: r.mix_repeats for r in out.collect()}
    assert len(set(repeats.values())) > 3 and repeats.get(None) == repeats.get("")
    assert out.select("mix_key").distinct().count() >= out.filter("length(text) > 0").count()


def test_best_fit_plan_round_trip():
    rng = np.random.default_rng(3)
    for capacity in (5, 17, 64):
        counts = Counter(rng.integers(1, capacity + 1, 400).tolist())
        fill, ranks = defaultdict(list), defaultdict(set)
        for length, rank, n, first, each, offset in best_fit_plan(counts, capacity):
            for k in range(n):
                ranks[length].add(rank + k)
                fill[first + k // each].append((offset + k % each * length, length))
        assert {length: len(r) for length, r in ranks.items()} == dict(counts)
        for parts in fill.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
        # One piece at a time gives as many sequences.
        spaces = []
        for length in sorted(counts.elements(), reverse=True):
            fits = [s for s in spaces if s >= length]
            if fits:
                spaces.remove(min(fits))
                spaces.append(min(fits) - length)
            else:
                spaces.append(capacity - length)
        assert len(fill) == len(spaces)


def test_packing_plain_words():
    """Words encoded by merges alone have the tokenizer's ids."""
    from random import Random

    from tokenizers import Tokenizer

    model = tokenizer_text()
    encoder, tokenizer = WordEncoder(model), Tokenizer.from_str(model)
    assert encoder.plain is not None
    draw = Random(5)
    letters = [chr(c) for c in range(97, 123)] * 2 + [chr(c) for c in range(0xDF, 0x100)] + list("\u00c9\u00d7\u0416\u0301'9")
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    parts = [t.removesuffix("</w>") for t in tokenizer.get_vocab() if t.removesuffix("</w>").isascii()]
    texts = [
        "".join(draw.choices(letters, k=draw.randint(0, 9)) + draw.choices(parts, k=draw.randint(0, 2)) + draw.choices(marks, k=draw.randint(0, 3)))
        for _ in range(20_000)
    ]
    texts += [" ".join(texts[k : k + 50]) for k in range(0, len(texts), 50)]
    found = encoder.encode([t.encode() for t in texts])
    for text, ids in zip(texts, found, strict=True):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text


def test_packing_ids(spark, odd, empty):
    from tokenizers import Tokenizer

    model = tokenizer_text()
    tokenizer = Tokenizer.from_str(model)
    texts = [t or "" for _, t, *_ in ODD] + [r.text for r in frame(spark).collect()] + ["é." * 9, "a., b;c; 'S't"]
    found = WordEncoder(model).encode([t.encode() for t in texts])
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:80]
    packed = pack_documents(odd, capacity=128, with_ids=True)
    rows = packed.collect()
    by_sequence = {r.sequence_id: r.ids for r in packed_sequences(packed).collect()}
    assert all(len(ids) <= 128 for ids in by_sequence.values())
    for r in rows:
        assert by_sequence[r.sequence_id][r.offset : r.offset + r.length] == r.ids
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    assert sum(r.doc_id == 3 for r in rows) == 2 and [r.ids for r in rows if r.doc_id == 4] == [[1]]
    assert pack_documents(empty).count() == 0


def test_language(spark, odd, empty):
    docs = frame(spark)
    found = identify_language(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert held and np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    rows = identify_language(odd).collect()
    assert len(rows) == len(ODD) and {r.lang_pred for r in rows if r.doc_id in (4, 5, 8, 9)} == {"und"}
    assert identify_language(empty).count() == 0


def test_quality(spark, odd, empty):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = queries.op8_quality(spark, folder).join(labels, "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    few = spark.createDataFrame([(1, 1), (6, 0), (None, 1), (5, None), (99, 0)], "doc_id long, quality int")
    rows = classify_quality(odd, few).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in classify_quality(odd, few.filter("false")).collect()} == {0.5}
    assert classify_quality(empty, few).count() == 0


def test_license_places(odd, empty):
    rows = {r.doc_id: r for r in license_scan(odd).filter("doc_id is not null").collect()}
    exact = sorted((m.start, m.label) for m in rows[10].matches if m.exact)
    assert exact == [(0, "mit"), (5, "cc-by-nc"), (8, "apache-2")] and rows[10].n_words == 13
    assert rows[4].n_words == 0 and rows[4].matches == [] and license_scan(empty).count() == 0


def test_license_join_is_exact():
    rng = np.random.default_rng(5)
    templates = make_templates(0.8, [("a b c", "x")], [("a b c d e f g", "y"), ("b b k", "z")])
    words = [bytes([c]) for c in b"abcdefghk"]
    order_words(templates, {w: int(rng.integers(1, 9)) for w in words})
    for _ in range(200):
        text = [words[k] for k in rng.integers(0, len(words), rng.integers(0, 40))]
        for t in templates:
            prefix = {w for w, rank in t.order.items() if rank <= len(t.order) - t.need}
            places = [i for i, w in enumerate(text) if w in prefix]
            got = sorted(matching_blocks(text, t, places))
            want = []
            for s in range(max(0, len(text) - len(t.words)) + 1):
                share = len(set(text[s : s + len(t.words)]) & set(t.words)) / len(set(t.words))
                if share >= 0.8 - 1e-9:
                    want.append((s, share))
            assert got == want


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(1000, 1040)]
    want = least_reachable(pairs, {x for p in pairs for x in p})
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {n: c for n, c in want.items() if n != c}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def reference_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_simhash(spark, odd, empty):
    docs = frame(spark).unionByName(odd.selectExpr("doc_id + 100000 doc_id", "text", "lang", "source", "1L n_chars"))
    rows = [r for r in docs.collect() if r.doc_id is not None]
    fps = {r.doc_id: reference_fingerprint(r.text) for r in rows}
    ids = sorted(fps)
    want = least_reachable(
        [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 4], ids
    )
    for r in simhash.simhash_dedup(docs).filter("doc_id is not null").collect():
        assert (r.fp % 2**64, r.component_id) == (fps[r.doc_id], want[r.doc_id])
    assert simhash.simhash_dedup(empty).count() == 0


@pytest.mark.parametrize("pieces, block", [(3, 50_000), (2, 50_000), (3, 5)])
def test_simhash_links_are_complete(spark, pieces, block):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    values = set(base.tolist())
    for b in base.tolist():  # chains of neighbours, a crowd around the first
        for _ in range(120 if b == base[0] else 4):
            for bit in rng.integers(0, 64, rng.integers(1, 6)).tolist():
                b ^= 1 << bit
            values.add(b)
    values = sorted(values)
    ids = list(range(len(values)))
    data = [(int(np.uint64(v).view(np.int64)), i) for v, i in zip(values, ids)]
    found = simhash.links(spark.createDataFrame(data, "fp long, rep long"), 4, pieces, block).collect()
    assert all((values[r.a] ^ values[r.b]).bit_count() <= 64 for r in found)
    pairs = [(i, j) for i in ids for j in ids if i < j and (values[i] ^ values[j]).bit_count() <= 4]
    assert least_reachable([(r.a, r.b) for r in found], ids) == least_reachable(pairs, ids)


@pytest.mark.parametrize("block", [4096, 8])
def test_embeddings(spark, block):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((150, 16))
    near = base[rng.integers(0, 20, 200)] + 0.08 * rng.standard_normal((200, 16))
    x = np.concatenate([base, near, base[:5] * 3, base[:5]]).astype(np.float32)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [1.0, 2.0]]
    rows += [(1000 + k, v, 1) for k, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int")
    got = {r.vec_id: r for r in emb.embedding_dedup(df, block=block).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = u @ u.T >= 0.95
    np.fill_diagonal(linked, False)
    n = linked.sum(axis=1)
    assert all(got[i].n_links <= n[i] for i in range(len(x)))
    assert sum(got[i].n_links for i in range(len(x))) >= 0.9 * n.sum()
    want = least_reachable(np.argwhere(linked).tolist(), range(len(x)))
    assert np.mean([got[i].component_id == want[i] for i in range(len(x))]) > 0.9
    assert all(got[1000 + k].n_links == 0 and got[1000 + k].kept for k in range(len(odd)))
    assert emb.embedding_dedup(df.filter("false")).count() == 0


def reference_repeats(texts, length):
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=int)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        out.append(bytes(np.frombuffer(t, np.uint8)[np.cumsum(gone[:-1]) == 0]))
    return out


@pytest.mark.parametrize("crowd", [4000, 2])
def test_repeats(spark, crowd):
    rng = np.random.default_rng(6)

    def noise(n):
        return "".join(rng.choice(list("abcdé \n"), n))

    passages = [noise(n) for n in (45, 60, 150, 400)]
    texts = [noise(int(rng.integers(0, 300))) + passages[k % 4] + noise(int(rng.integers(0, 300))) for k in range(60)]
    texts += [passages[3][20:200], "xyz " * 90, "ab" * 100, "", None, texts[0], noise(39), LONG, LONG[:900]]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, texts[1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_bytes int")
    got = repeats.remove_repeats(df, length=40, gram=8, crowd=crowd).collect()
    want = Counter(zip([r[0] for r in rows], reference_repeats([(t or "").encode() for _, t in rows], 40)))
    assert Counter((r.doc_id, bytes(r.text)) for r in got) == want
    assert all(r.n_bytes - sum(x.end - x.first for x in r.removed) == len(r.text) for r in got)
    assert repeats.remove_repeats(df.filter("false")).count() == 0


def test_repeats_tell_rows_of_one_id_apart(spark):
    """Texts whose 32-bit hashes are equal, without ids and under one id."""
    from pyspark.sql import functions as F

    made = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 512).alias("s"))
    text = F.concat(*[F.sha2(F.concat("s", F.lit(str(k))), 256) for k in range(5)]).alias("text")
    pairs = made.select(text).groupBy(F.hash("text")).agg(F.collect_list("text").alias("t")).filter(F.size("t") > 1)
    a, b = pairs.first()["t"][:2]
    for doc_id in (None, 7):
        df = spark.createDataFrame([(doc_id, a), (doc_id, b), (1, a)], "doc_id long, text string")
        got = Counter((r.doc_id, bytes(r.text)) for r in repeats.remove_repeats(df).collect())
        assert got == Counter([(doc_id, b""), (doc_id, b.encode()), (1, b"")])


def test_match_lengths():
    rng = np.random.default_rng(7)

    def common(a, b):
        return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    for trial in range(40):
        texts = [bytes(rng.integers(97, 99 + trial % 5, rng.integers(1, 40)).astype(np.uint8)) for _ in range(4)]
        texts.append(texts[0])
        places = [(i, j) for i, t in enumerate(texts) for j in range(len(t))]
        got = repeats.match_lengths(texts)
        for i, j in places:
            assert got[i][j] == max(common(texts[i][j:], texts[a][b:]) for a, b in places if (a, b) != (i, j))


def test_pipeline(spark):
    docs = frame(spark)
    before = {r.doc_id: r for r in docs.collect()}
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "best-fit packing":
            assert out.columns == docs.columns
        rows = out.collect()
        ids = Counter(r.doc_id for r in rows)
        if name == "exact dedup":
            best = {}
            for r in docs.collect():
                key = (r.text or "").translate(ASCII)
                best[key] = max(best.get(key, r.doc_id), r.doc_id)
            assert ids == Counter(best.values())
        elif name == "SimHash near-dedup":
            kept = sorted(docs.collect(), key=lambda r: r.doc_id)
            first = {}
            for r, group in zip(kept, brute_groups([r.text for r in kept])):
                first.setdefault(group, r.doc_id)
            assert ids == Counter(first.values())
        elif name == "best-fit packing":
            assert sum(r.piece == 0 for r in rows) == docs.count()
        assert set(ids) <= set(before)
        sizes.append(len(rows))
        docs = out
    assert sizes[0] >= sizes[1] >= sizes[2] > 0
    assert corpus_pipeline.run(spark, SMALL).count() == sizes[-1]
