"""Language identification by naive Bayes over hashed character n-grams.

Counting is one pass over the training rows: every task adds up its n-grams per
language and bucket, the sums meet by (language, bucket).  The model is the
matrix of log-probabilities, languages x buckets, which has a fixed size per
language and is broadcast.  Prediction looks up all n-grams of a batch of texts
at once in numpy and adds them up per text.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.functions.values import quoted
from cohort.llm.shared import documents, id_type, in_fold, slices

ORDERS = (1, 2, 3)
BITS = 15
SMOOTHING = 0.5
UNDETERMINED = "und"
#: Characters that are hashed at one time.
UNIT_CHARS = 1 << 18
#: Odd multipliers of the hash, one per character of an n-gram.
FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)


def ngram_buckets(chars: np.ndarray, order: int, bits: int = BITS) -> np.ndarray:
    """The bucket of the n-gram that starts at each place, for all but the last few."""
    n = len(chars) - order + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint32)
    mixed = np.full(n, order * 0x2545F491 & 0xFFFFFFFF, dtype=np.uint32)
    for k in range(order):
        mixed ^= chars[k : k + n] * np.uint32(FACTORS[k])
        mixed = (mixed << np.uint32(7)) | (mixed >> np.uint32(25))
    mixed *= np.uint32(0x9E3779B1)
    return mixed >> np.uint32(32 - bits)


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters in lower case, one text after the other, and where each begins."""
    lowered = [t.lower() for t in texts]
    starts = np.zeros(len(texts), dtype=np.int64)
    np.cumsum([len(t) for t in lowered[:-1]], out=starts[1:])
    chars = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return chars, starts


def _inside(n: int, starts: np.ndarray, order: int) -> np.ndarray | None:
    """Places whose n-gram would run into the next text."""
    ends = [starts[1:] - k for k in range(1, order)]
    if not ends or len(starts) < 2:
        return None
    outside = np.concatenate(ends)
    return outside[(outside >= 0) & (outside < n)]


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def count_ngrams(docs: DataFrame, bits: int = BITS, orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """lang, bucket, n over ``docs`` (lang, text); bucket -1 counts the texts."""
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = defaultdict(lambda: np.zeros(size, dtype=np.int64))
        texts_of: dict[str, int] = defaultdict(int)
        for batch in batches:
            by_lang = defaultdict(list)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if has_letter(text):
                    by_lang[lang].append(text)
            for lang, texts in by_lang.items():
                texts_of[lang] += len(texts)
                for a, b in slices([len(t) for t in texts], UNIT_CHARS):
                    chars, starts = _code_points(texts[a:b])
                    for order in orders:
                        buckets = ngram_buckets(chars, order, bits)
                        totals[lang] += np.bincount(buckets, minlength=size)
                        outside = _inside(len(buckets), starts, order)
                        if outside is not None:
                            totals[lang] -= np.bincount(buckets[np.unique(outside)], minlength=size)
        for lang, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (len(used) + 1), pa.string()),
                    pa.array(np.append(used, -1), pa.int32()),
                    pa.array(np.append(total[used], texts_of[lang]), pa.int64()),
                ],
                names=["lang", "bucket", "n"],
            )

    counted = docs.select("lang", "text").mapInArrow(count, "lang string, bucket int, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class LanguageModel:
    langs: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # languages x buckets
    bits: int
    orders: tuple[int, ...]

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The place of the best language and its posterior, for texts with letters."""
        totals = np.empty((len(self.langs), len(texts)))
        for a, b in slices([len(t) for t in texts], UNIT_CHARS):
            chars, starts = _code_points(texts[a:b])
            totals[:, a:b] = self.log_prior[:, None]
            for order in self.orders:
                buckets = ngram_buckets(chars, order, self.bits)
                outside = _inside(len(buckets), starts, order)
                for k, table in enumerate(self.log_prob):
                    terms = np.zeros(len(chars), dtype=np.float32)
                    terms[: len(buckets)] = table[buckets]
                    if outside is not None:
                        terms[outside] = 0
                    totals[k, a:b] += np.add.reduceat(terms, starts, dtype=np.float64)
        best = totals.argmax(axis=0)
        posterior = np.exp(totals - totals.max(axis=0))
        return best, 1.0 / posterior.sum(axis=0)


def fit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    bits: int = BITS,
    orders: tuple[int, ...] = ORDERS,
    smoothing: float = SMOOTHING,
) -> LanguageModel | None:
    """A model of all rows with a language and a letter; None if there is no such row."""
    rows = docs.select(quoted(lang_col).cast("string").alias("lang"), quoted(text_col).alias("text"))
    counts = count_ngrams(rows.filter(F.col("lang").isNotNull()), bits, orders).toArrow()
    if not counts.num_rows:
        return None
    lang = np.asarray(counts.column("lang").to_pylist(), dtype=object)
    langs = sorted(set(lang))
    place = {name: k for k, name in enumerate(langs)}
    rows_of = np.fromiter(map(place.__getitem__, lang), dtype=np.int64, count=len(lang))
    bucket, n = counts.column("bucket").to_numpy(), counts.column("n").to_numpy()
    matrix = np.full((len(langs), 1 << bits), smoothing)
    texts = np.zeros(len(langs))
    text_rows = bucket < 0
    texts[rows_of[text_rows]] = n[text_rows]
    matrix[rows_of[~text_rows], bucket[~text_rows]] += n[~text_rows]
    log_prob = np.log(matrix / matrix.sum(axis=1, keepdims=True)).astype(np.float32)
    return LanguageModel(langs, np.log(texts / texts.sum()), log_prob, bits, orders)


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, lang_pred, score for ``docs`` (doc_id, text)."""
    shared_model = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared_model.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            pred = np.full(len(texts), UNDETERMINED, dtype=object)
            certainty = np.zeros(len(texts))
            known = [i for i, text in enumerate(texts) if has_letter(text)] if own else []
            if known:
                best, posterior = own.predict([texts[i] for i in known])
                pred[known] = np.asarray(own.langs, dtype=object)[best]
                certainty[known] = posterior
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred, pa.string()), pa.array(certainty)],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        score, f"doc_id {id_type(docs)}, lang_pred string, score double"
    )


def identify_language(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    parts: int = 4,
    held_out: int = 2,
) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``.

    Learns from the rows with a language whose id's crc32 modulo ``parts`` is not
    ``held_out``; only the text is an input of a prediction.  ``und`` with score 0
    is given to null texts, texts without a letter, and to all if nothing could be
    learned.  Of equally likely languages the first by name is taken.  A null id
    is not held out.  Rows that repeat count as often as they are there.  An empty
    table gives an empty result; other columns are ignored.
    """
    mine = documents(docs, id_col, text_col, lang_col)
    apart = in_fold(F.col("doc_id"), parts, held_out)
    model = fit(mine.filter(~apart), "text", lang_col)
    found = predict(mine, model)
    return found.select(
        "doc_id", in_fold(F.col("doc_id"), parts, held_out).alias("held_out"), "lang_pred", "score"
    )
