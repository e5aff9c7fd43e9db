"""A quality classifier of supervised subword embeddings.

A document is the mean of the learned vectors of its features: its words, the
character n-grams of its words (with their ends marked by a space), and whether
a word repeats the one before, all hashed into one table.  A softmax layer turns
the mean into class probabilities.  Table and layer are trained together by
stochastic gradient descent in numpy, on at most ``sample`` labelled documents
(the ones with the smallest hash of their id) in one Spark task.

Since mean and layer are linear, a trained model is one number per bucket and
class; scoring looks up all features of a batch of texts at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.functions.values import quoted
from cohort.llm.language_id import UNIT_CHARS, ngram_buckets
from cohort.llm.shared import documents, in_fold, slices

#: Labelled documents a model is trained on, at most.
SAMPLE = 4_000
BITS, DIM, EPOCHS, RATE = 15, 8, 12, 1.0
ORDERS = (3, 4)
_POWERS: dict[int, np.ndarray] = {}


def features(texts: list[str], bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs (bucket, place in the joined text) of all features, and where texts begin.

    The first pair of the result is (text starts, text of each place's end).
    """
    padded = [f" {t} " for t in texts]
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in padded], out=starts[1:])
    chars = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    # ASCII white space parts words; all of it looks like a space.
    blank = (chars == 32) | ((chars >= 9) & (chars <= 13))
    chars = np.where(blank, np.uint32(32), chars)
    found = []
    for order in ORDERS:
        buckets = ngram_buckets(chars, order, bits)
        valid = np.ones(len(buckets), dtype=bool)
        for k in range(1, order - 1):
            valid &= ~blank[k : k + len(buckets)]
        valid &= ~(blank[: len(buckets)] & blank[order - 1 : order - 1 + len(buckets)])
        places = np.flatnonzero(valid)
        found.append((buckets[places], places))
    begin = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    if len(begin):
        inside = np.flatnonzero(~blank)
        first = np.searchsorted(inside, begin)
        within = inside - np.repeat(begin, np.diff(np.append(first, len(inside))))
        words = np.add.reduceat(chars[inside].astype(np.uint64) * _powers(int(within.max()) + 1)[within], first)
        hashed = (words * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
        found.append((hashed.astype(np.uint32), begin))
        same = np.zeros(len(begin), dtype=np.uint32)
        same[1:] = words[1:] == words[:-1]
        # Two fixed buckets: the word differs from, or repeats, the one before.
        found.append((same, begin))
    return [(starts, chars), *found]


def _powers(n: int) -> np.ndarray:
    size = 1 << max(6, (n - 1).bit_length())
    if size not in _POWERS:
        factors = np.full(size, 0x100000001B3, dtype=np.uint64)
        _POWERS[size] = np.multiply.accumulate(factors)
    return _POWERS[size]


def bag(text: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's features and their shares, which add up to 1."""
    counts = np.zeros(1 << bits, dtype=np.int64)
    for buckets, _ in features([text], bits)[1:]:
        counts += np.bincount(buckets, minlength=1 << bits)
    used = np.flatnonzero(counts)
    return used, counts[used] / max(1, counts.sum())


@dataclass
class QualityModel:
    classes: list[int]
    vectors: np.ndarray  # buckets x dim
    layer: np.ndarray  # dim x classes
    bias: np.ndarray
    bits: int

    def __post_init__(self) -> None:
        self.weights = np.ascontiguousarray((self.vectors @ self.layer).T, dtype=np.float32)

    def probabilities(self, texts: list[str]) -> np.ndarray:
        """texts x classes; a text without features gets the bias alone."""
        out = np.zeros((len(texts), len(self.classes)))
        for a, b in slices([len(t) for t in texts], UNIT_CHARS):
            (starts, _), *found = features(texts[a:b], self.bits)
            n = np.zeros(b - a)
            total = np.zeros((len(self.classes), b - a))
            for buckets, places in found:
                # Places ascend, so the features of a text are one range.
                cuts = np.searchsorted(places, starts)
                n += np.diff(cuts)
                for k, table in enumerate(self.weights):
                    sums = np.concatenate(([0.0], np.cumsum(table[buckets], dtype=np.float64)))
                    total[k] += sums[cuts[1:]] - sums[cuts[:-1]]
            out[a:b] = (total / np.maximum(n, 1)).T + self.bias
        out = np.exp(out - out.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)


def train(
    bags: list[tuple[np.ndarray, np.ndarray]],
    labels: list[int],
    bits: int = BITS,
    dim: int = DIM,
    epochs: int = EPOCHS,
    rate: float = RATE,
    seed: int = 7,
) -> QualityModel:
    """Stochastic gradient descent, one document at a time, with a falling rate."""
    classes = sorted(set(labels))
    place = {c: k for k, c in enumerate(classes)}
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim))
    layer = np.zeros((dim, len(classes)))
    bias = np.zeros(len(classes))
    steps, step = epochs * len(bags), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            used, share = bags[i]
            now = rate * (1 - step / steps)
            step += 1
            rows = vectors[used]
            mean = share @ rows
            out = mean @ layer + bias
            out = np.exp(out - out.max())
            error = out / out.sum()
            error[place[labels[i]]] -= 1
            back = layer @ error
            layer -= now * np.outer(mean, error)
            bias -= 0.1 * now * error
            # As is usual for mean embeddings, each feature moves by the full error
            # of the mean, weighted by how often it is there.
            vectors[used] = rows - now * np.minimum(share * len(used), 4.0)[:, None] * back
    return QualityModel(classes, vectors.astype(np.float32), layer, bias, bits)


def fit(labelled: DataFrame, sample: int = SAMPLE, bits: int = BITS) -> QualityModel | None:
    """A model of ``labelled`` (doc_id, text, label), at most ``sample`` rows."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for key, text, label in zip(*[c.to_pylist() for c in batch.columns]):
                rows.append((str(key), label, *bag(text, bits)))
        if not rows:
            return
        rows.sort(key=lambda row: row[:2])
        model = train([row[2:] for row in rows], [row[1] for row in rows], bits)
        parts = (model.vectors, model.layer, model.bias)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.classes], pa.list_(pa.int32()))]
            + [pa.array([p.astype("<f8").tobytes()], pa.binary()) for p in parts],
            names=["classes", "vectors", "layer", "bias"],
        )

    found = (
        labelled.select("doc_id", "text", F.col("label").cast("int"))
        .repartition(1)
        .mapInArrow(learn, "classes array<int>, vectors binary, layer binary, bias binary")
        .collect()
    )
    if not found:
        return None
    row = found[0]
    classes = list(row["classes"])

    def matrix(part: str, columns: int) -> np.ndarray:
        return np.frombuffer(bytes(row[part]), dtype="<f8").reshape(-1, columns)

    layer = matrix("layer", len(classes))
    return QualityModel(
        classes, matrix("vectors", len(layer)), layer, matrix("bias", len(classes))[0], bits
    )


def score(docs: DataFrame, model: QualityModel | None, positive: int = 1) -> DataFrame:
    """doc_id, score for ``docs`` (doc_id, text): the probability of ``positive``."""
    return score_rows(docs.select("doc_id", "text"), model, positive=positive, name="score").drop("text")


def score_rows(
    docs: DataFrame, model: QualityModel | None, text_col: str = "text", positive: int = 1,
    name: str = "quality_score",
) -> DataFrame:
    """All columns of ``docs`` plus the score, without a join; null text is empty."""
    if name in docs.columns:
        raise ValueError(f"column {name!r} is there already")
    shared_model = docs.sparkSession.sparkContext.broadcast(model)
    columns, at = list(docs.columns), docs.columns.index(text_col)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared_model.value
        for batch in batches:
            scores = np.full(batch.num_rows, 0.5 if own is None else 0.0)
            if own is not None and positive in own.classes and batch.num_rows:
                texts = [t or "" for t in batch.column(at).to_pylist()]
                scores = own.probabilities(texts)[:, own.classes.index(positive)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*columns, name]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(apply, f"{fields}, {name} double")


def training_rows(
    docs: DataFrame, labels: DataFrame, label_col: str, parts: int, held_out: int, sample: int
) -> DataFrame:
    """doc_id, text, label of the chosen labelled documents (docs: doc_id, text)."""
    chosen = (
        labels.select("doc_id", quoted(label_col).alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .filter(~in_fold(F.col("doc_id"), parts, held_out))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(sample)
    )
    # At most ``sample`` rows of an id and a number.
    return docs.join(F.broadcast(chosen), "doc_id")


def fit_labels(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    parts: int = 3,
    held_out: int = 1,
    sample: int = SAMPLE,
) -> QualityModel | None:
    """A model of the labelled documents that are not held out."""
    mine = documents(docs, id_col, text_col)
    marks = labels.select(quoted(id_col).alias("doc_id"), quoted(label_col).alias("label"))
    return fit(training_rows(mine, marks, "label", parts, held_out, sample))


def classify_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    parts: int = 3,
    held_out: int = 1,
    sample: int = SAMPLE,
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Learns from labelled ids whose crc32 modulo ``parts`` is not ``held_out``;
    only the text is an input of a score.  Null text counts as empty; empty texts
    get what the bias alone says.  Labels that are null or belong to no document
    teach nothing; an id with two labels teaches both.  Without any label the
    score is 0.5.  A null id is not held out.  Rows that repeat are each scored.
    An empty table gives an empty result; other columns are ignored.
    """
    mine = documents(docs, id_col, text_col)
    model = fit_labels(docs, labels, id_col, text_col, label_col, parts, held_out, sample)
    return score(mine, model).select(
        "doc_id",
        in_fold(F.col("doc_id"), parts, held_out).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
