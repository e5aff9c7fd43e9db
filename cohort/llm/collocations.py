"""Phrase collocations by partitioned mining (SON).

The texts are dealt into ``SHARDS`` parts by their hashes.  A phrase that a language
has ``support`` times or more has, in one part at least, that share of ``support``
which the part has of the language's bytes.  So each part is mined completely at its
lowered support; what is frequent in any part is the union of candidates; another
pass counts all candidates exactly and adds the counts up over all parts.

The number of parts is fixed, as with parts of a fixed size the lowered support would
fall to 1 in a large corpus, and all phrases would be candidates.  A part is thus too
large for one task.  It is mined by two passes, first for words and pairs, then for
the longer phrases all of whose pairs are frequent.  A task sorts the hashes of the
phrases it reads and sends them on with their counts, packed by (part, range of
hashes); where such a range meets, the runs are merged and counted.  Hashes have 32
bits within their range: phrases that share one can only make a candidate too many.

Tasks do not hold the candidates.  They test phrases against a Bloom filter that has
a bounded size.  The filter lets every candidate pass, so what reaches ``support`` is
counted in full; what passes by chance is counted in full as well and dropped by its
count.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohort.functions.values import quoted
from cohort.llm.shared import HashFilter, hash_filter, materialize, spread

SUPPORT, WORDS, TOP = 100, 5, 2_000
UNDETERMINED = "und"
#: Parts of the corpus, each with its lowered support.
SHARDS = 8
#: Bytes of text whose phrases a task adds up, and that it cuts into words at a time.
UNIT_BYTES, CHUNK_BYTES = 16_000_000, 1_000_000
#: Phrases of one length whose hashes meet in one range, about.
RANGE = 1 << 20
#: Languages whose sizes tasks are told; the others are mined at support 1.
LANGUAGES = 1_000
#: Rows that one task ranks at first.
RANKED = 100_000

#: What ends a piece, and the byte that stands for it.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_END = b"\n"
_BYTES = bytes(
    10 if b in _ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class _Vocabulary(dict):
    """The number of each word, given as words come; 0 is the end of a piece."""

    def __init__(self) -> None:
        super().__init__({_END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Unit:
    """Texts of one language that a task holds, as numbers of words."""

    def __init__(self) -> None:
        self.vocabulary = _Vocabulary()
        self.parts: list[np.ndarray] = []
        self.held: list[bytes] = []
        self.waiting = 0

    def add(self, text: bytes) -> None:
        self.held.append(text)
        self.waiting += len(text)
        if self.waiting >= CHUNK_BYTES:
            self._cut()

    def _cut(self) -> None:
        joined = _END.join(self.held).translate(_BYTES).replace(_END, b" \n ")
        words = [w for w in joined.split(b" ") if w]
        words.append(_END)
        number = self.vocabulary.__getitem__
        self.parts.append(np.fromiter(map(number, words), np.int32, len(words)))
        self.held, self.waiting = [], 0

    def numbers(self) -> np.ndarray:
        if self.held:
            self._cut()
        return np.concatenate(self.parts) if self.parts else np.empty(0, np.int32)


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter((xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def mixed(hashes: np.ndarray, lang: str, length: int) -> np.ndarray:
    """Well spread hashes of phrases of one language and number of words."""
    from xxhash import xxh3_64_intdigest

    return spread(hashes ^ np.uint64(xxh3_64_intdigest(lang.encode(), length)))


def phrases(
    numbers: np.ndarray, hashes: np.ndarray, most: int, passes
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """length, a place, the count and the hash of each phrase that passes, and all of whose parts do.

    ``passes(length, hashes)`` says which do; ids of phrases are exact.
    """
    good = passes(1, hashes)
    good[0] = False
    counts = np.bincount(numbers, minlength=len(hashes))
    found = np.flatnonzero(good & (counts > 0))
    place = np.zeros(len(hashes), np.int64)
    place[numbers[::-1]] = np.arange(len(numbers))[::-1]
    yield 1, place[found], counts[found], hashes[found]
    alive, ids, rolled = np.flatnonzero(good[numbers]), numbers.astype(np.int64), hashes[numbers]
    for length in range(2, most + 1):
        # Places follow each other where the phrase at the next place passed too.
        alive = alive[:-1][np.diff(alive) == 1]
        rolled = rolled[:-1] * _FACTOR + hashes[numbers[length - 1 :]]
        alive = alive[passes(length, rolled[alive])]
        if not len(alive):
            return
        code = ids[alive] * len(hashes) + numbers[alive + length - 1]
        _, place, inverse, counts = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
        yield length, alive[place], counts, rolled[alive[place]]
        ids[alive] = inverse


def occurrences(
    numbers: np.ndarray, hashes: np.ndarray, lang: str, lengths: tuple[int, int], known: HashFilter | None
) -> Iterator[np.ndarray]:
    """The hashes of all phrases of these lengths whose parts of one word less, where
    they are shorter than these lengths, are known."""
    alive, rolled = np.flatnonzero(numbers), hashes[numbers]
    for length in range(1, lengths[1] + 1):
        if length > 1:
            alive = alive[:-1][np.diff(alive) == 1]
            rolled = rolled[:-1] * _FACTOR + hashes[numbers[length - 1 :]]
        found = mixed(rolled[alive], lang, length)
        if length >= lengths[0]:
            yield found
        elif known is not None:
            alive = alive[known(found)]


def _units(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[dict[tuple, Unit]]:
    """The texts of one task by all columns but the last, ``limit`` bytes at a time."""
    found: dict[tuple, Unit] = defaultdict(Unit)
    size = 0
    for batch in batches:
        *keys, texts = (c.to_pylist() for c in batch.columns)
        for key, text in zip(zip(*keys), texts):
            found[key].add(text)
            size += len(text)
            if size >= limit:
                yield found
                found, size = defaultdict(Unit), 0
    if found:
        yield found


def lowered(texts: DataFrame, support: int, shards: int) -> tuple[dict[tuple[int, str], int], int]:
    """The support of each part and language, for the largest languages; and into how
    many ranges (a power of 2) the hashes of a part are cut."""
    sizes = texts.groupBy("lang", "shard").agg(F.sum(F.octet_length("text")).alias("size"))
    sizes = materialize(sizes, "language-sizes")
    top = sizes.groupBy("lang").agg(F.sum("size").alias("total")).orderBy(F.desc("total"), "lang").limit(LANGUAGES)
    least = {
        (r["shard"], r["lang"]): max(1, -(-support * r["size"] // max(1, r["total"])))
        for r in sizes.join(top, "lang").collect()
    }
    # A word takes 6 bytes, about.
    words = (sizes.agg(F.sum("size")).first()[0] or 0) // 6
    return least, 1 << min(31, (words // shards // RANGE).bit_length())


def mine(
    texts: DataFrame, support: int, least: dict[tuple[int, str], int], ranges: int, lengths: tuple[int, int],
    known: HashFilter | None, unit_bytes: int,
) -> DataFrame:
    """hash: the first bits of the hashes of phrases that are frequent in a part.

    Phrases have these lengths; ``known`` holds the shorter ones.
    """
    shared = texts.sparkSession.sparkContext.broadcast((least, known))
    bits = ranges.bit_length() - 1
    kind = np.uint8 if support < 256 else np.int64

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, known = shared.value
        for units in _units(batches, unit_bytes):
            for (shard, lang), own in units.items():
                numbers, hashes = own.numbers(), word_hashes(list(own.vocabulary))
                # More than the lowered support makes no difference.
                enough = least.get((shard, lang), 1)
                for found in occurrences(numbers, hashes, lang, lengths, known):
                    if not len(found):
                        continue
                    found = np.sort(found >> np.uint64(32 - bits))
                    starts = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
                    n = np.minimum(np.diff(np.append(starts, len(found))), enough).astype(kind)
                    found = found[starts]
                    places = (found >> np.uint64(32)).astype(np.int64)
                    cuts = np.append(np.flatnonzero(np.append(True, places[1:] != places[:-1])), len(places))
                    low = found.astype(np.uint32)
                    runs = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(runs), shard, np.int32)), pa.array(places[cuts[:-1]]),
                            pa.array(np.full(len(runs), enough, np.int64)),
                            pa.array([low[a:b].tobytes() for a, b in runs], pa.binary()),
                            pa.array([n[a:b].tobytes() for a, b in runs], pa.binary()),
                        ],
                        names=["shard", "place", "least", "low", "n"],
                    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            row for batch in batches
            for row in zip(*(batch.column(c).to_pylist() for c in ("shard", "place", "least", "low", "n")))
        )
        for (_, place), runs in groupby(rows, key=lambda r: r[:2]):
            runs = list(runs)
            low = np.concatenate([np.frombuffer(r[3], np.uint32) for r in runs])
            n = np.concatenate([np.frombuffer(r[4], kind) for r in runs]).astype(np.int64)
            # Languages of one part differ in their lowered supports.
            share = np.repeat([1 / r[2] for r in runs], [len(r[3]) // 4 for r in runs]) * n
            order = np.argsort(low, kind="stable")
            low = low[order]
            starts = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
            found = low[starts][np.add.reduceat(share[order], starts) >= 1 - 1e-6]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.astype(np.int64) | np.int64(place << 32))], names=["hash"]
            )

    packed = texts.select("shard", "lang", "text").mapInArrow(
        pack, "shard int, place long, least long, low binary, n binary"
    )
    met = packed.repartition("shard", "place").sortWithinPartitions("shard", "place")
    return materialize(met.mapInArrow(merge, "hash long"), "local-phrases")


def count(
    texts: DataFrame, support: int, known: HashFilter, ranges: int, most: int, unit_bytes: int
) -> DataFrame:
    """lang, phrase, k (words), n: all phrases with ``support`` occurrences, stored; a row
    with k = 0 has the number of all words.

    Tasks send the phrases that pass the filter on with their counts, packed by
    language and range of hashes.
    """
    shared_filter = texts.sparkSession.sparkContext.broadcast(known)
    drop = np.uint64(64 - ranges.bit_length() + 1)

    def rows(lang: str, places: list[int], names: list[list[bytes]], n: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(places), pa.string()), pa.array(places, pa.int64()),
                pa.array([b"\n".join(x) for x in names], pa.binary()),
                pa.array([x.astype(np.int64).tobytes() for x in n], pa.binary()),
            ],
            names=["lang", "place", "names", "n"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = shared_filter.value
        for units in _units(batches, unit_bytes):
            for (lang,), own in units.items():
                numbers = own.numbers()
                words = list(own.vocabulary)

                def good(length, hashes):
                    return passes(mixed(hashes, lang, length))  # noqa: B023

                yield rows(lang, [-1], [[b""]], [np.array([np.count_nonzero(numbers)])])
                for length, at, n, found in phrases(numbers, word_hashes(words), most, good):
                    place = np.zeros(len(at), np.int64)
                    if ranges > 1:
                        place = (mixed(found, lang, length) >> drop).astype(np.int64)
                    order = np.argsort(place, kind="stable")
                    at, n, place = at[order], n[order], place[order]
                    cuts = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(at) else []
                    for a, b in zip(cuts, [*cuts[1:], len(at)]):
                        own_words = [[words[k] for k in numbers[at[a:b] + j].tolist()] for j in range(length)]
                        yield rows(lang, [int(place[a])], [[b" ".join(p) for p in zip(*own_words)]], [n[a:b]])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = (
            row for batch in batches
            for row in zip(*(batch.column(c).to_pylist() for c in ("lang", "place", "names", "n")))
        )
        for (lang, place), runs in groupby(packed, key=lambda r: r[:2]):
            runs = list(runs)
            names = pa.concat_arrays([pa.array(r[2].split(b"\n"), pa.binary()) for r in runs]).dictionary_encode()
            n = np.zeros(len(names.dictionary), np.int64)
            np.add.at(n, names.indices.to_numpy(), np.concatenate([np.frombuffer(r[3], np.int64) for r in runs]))
            often = np.flatnonzero((n >= support) | (place < 0))
            found = names.dictionary.take(pa.array(often)).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(often), pa.string()), found, pa.array(n[often])], names=["lang", "phrase", "n"]
            )

    packed = texts.select("lang", "text").mapInArrow(pack, "lang string, place long, names binary, n binary")
    met = packed.repartition("lang", "place").sortWithinPartitions("lang", "place")
    found = met.mapInArrow(merge, "lang string, phrase string, n long")
    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return materialize(found.select("lang", "phrase", words.alias("k"), "n"), "phrases")


def _score(a: str, n: str, left: str, right: str) -> Column:
    """floor(1000 a n / (l r)), exact: factors have up to 17 digits."""
    whole = "cast({0} as decimal(17, 0))".format
    return F.expr(
        f"(cast(1000 as decimal(4, 0)) * {whole(a)} * {whole(n)}) div ({whole(left)} * {whole(right)})"
    )


def weakest_cuts(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, k, a, l, r, n, score of each phrase at its lowest-scoring cut."""
    cuts = (
        counts.filter("k > 1")
        .select("lang", "phrase", "k", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
        .withColumn("first", F.expr("substring_index(phrase, ' ', cut)"))
        .withColumn("rest", F.expr("substring(phrase, char_length(first) + 2)"))
    )
    known = counts.select("lang", "phrase", "n")
    return (
        cuts.join(known.withColumnsRenamed({"phrase": "first", "n": "l"}), ["lang", "first"])
        .join(known.withColumnsRenamed({"phrase": "rest", "n": "r"}), ["lang", "rest"])
        .join(totals, "lang")
        .groupBy("lang", "phrase", "k", "a", "n")
        .agg(F.min(F.struct(_score("a", "n", "l", "r").alias("score"), "cut", "l", "r")).alias("low"))
        .select("lang", "phrase", "k", "a", "low.l", "low.r", "n", "low.score")
    )


def covered(counts: DataFrame) -> DataFrame:
    """lang, phrase, longer: for phrases inside longer ones the count of the most frequent."""
    inside = F.expr(
        """flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1),
           s -> array_join(slice(split(phrase, ' '), s, m), ' '))))"""
    )
    return (
        counts.filter("k > 2")
        .select("lang", F.explode(F.array_distinct(inside)).alias("phrase"), "n")
        .groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    )


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    support: int = SUPPORT,
    words: int = WORDS,
    top: int = TOP,
    cover: int = 100,
    shards: int = SHARDS,
    unit_bytes: int = UNIT_BYTES,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    Texts get A-Z in lower case, are cut into pieces at ``.,;:!?`` and line breaks,
    and pieces into words at spaces and tabs.  Candidates are phrases of 2 to
    ``words`` words within a piece that occur ``support`` times or more.  A cut into
    first words and rest, with counts l and r, scores floor(1000 a n / (l r)) where
    the language has n words; the lowest-scoring cut counts, of equal ones the
    first.  A candidate inside a longer one that has at least ``cover`` percent of
    its count is left out.  Order: score and a descending, phrase by its bytes.

    A null text is empty and a null language ``und``; repeated rows count each time,
    ids play no part, other columns are ignored.  An empty table, or one without
    frequent phrases, gives an empty result.
    """
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    texts = docs.select(
        F.coalesce(quoted(lang_col).cast("string"), F.lit(UNDETERMINED)).alias("lang"),
        F.pmod(F.xxhash64(text), F.lit(shards)).cast("int").alias("shard"),
        text.cast("binary").alias("text"),
    )
    least, ranges = lowered(texts, support, shards)
    local = mine(texts, support, least, ranges, (1, 2), None, unit_bytes)
    if words > 2:
        pairs = hash_filter(local, 32 + ranges.bit_length() - 1)
        local = local.unionByName(mine(texts, support, least, ranges, (3, words), pairs, unit_bytes))
    found = count(texts, support, hash_filter(local, 32 + ranges.bit_length() - 1), ranges, words, unit_bytes)
    counts = found.filter("k > 0")
    totals = materialize(found.filter("k = 0").select("lang", "n"), "language-words")
    scored = materialize(
        weakest_cuts(counts, totals).join(covered(counts), ["lang", "phrase"], "left")
        .filter(F.col("longer").isNull() | (F.col("longer") * cover < F.col("a") * 100)),
        "collocations",
    )
    ranked = _first(scored, ["lang", "part"], top, scored.count() // RANKED + 1).drop("rank", "part")
    return _first(ranked, ["lang"], top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def _first(scored: DataFrame, by: list[str], top: int, parts: int = 1) -> DataFrame:
    if "part" in by:
        scored = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), "phrase")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
