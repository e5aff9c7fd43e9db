"""Best-fit packing of tokenized documents, planned on the histogram of lengths.

Documents are cut into pieces of at most ``capacity`` tokens.  The plan is made
on the driver from the number of pieces of each length, never from the pieces:
best-fit in descending length over at most ``capacity`` counts, with sequences
of equal free space handled as one interval.  It yields, per length, ranges of
ranks and the sequences and offsets they take.  Pieces then find their rank
within their length on the executors and look their place up in the plan.

Ranks come from row numbers within (length, slice of a hash) plus the number of
pieces in earlier slices, so a length that a third of all pieces have is spread.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohort.llm.shared import documents, id_type, in_turn, lean, materialize, process_memo

CAPACITY = 4096
END_ID = 1
#: Words whose ids a worker keeps; the memo starts anew when it is full.
MEMO_WORDS = 600_000
#: Words that are encoded as one text.
JOINED_WORDS = 512
#: Text that is split into words at one time, in bytes.
UNIT_BYTES = 1 << 20
SLICES, SLICE_ROWS = 256, 1_000_000

_MARK = rb"[!-/:-@\[-`{-~]"
#: Letters of Latin-1 outside ASCII in UTF-8, and those of them in lower case.
_LETTER, _LOWER = rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]", rb"\xc3[\x9f-\xb6\xb8-\xbf]"
_TRAILING_MARKS = re.compile(
    _MARK + rb"(?:(?<=[a-z0-9].)|(?<=" + _LETTER + rb".))" + _MARK + rb"*(?=[ \t\n\x0b\x0c\r]|\Z)"
)
#: Words that no step before the merges changes or splits.
_PLAIN = re.compile(rb"(?:[a-z]|" + _LOWER + rb")+|" + _MARK + rb"+")
_SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]")


def tokenizer_text(path: str | None = None) -> str:
    """The tokenizer file as text; it travels to the executors by broadcast."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return Path(path).read_text(encoding="utf-8")


class _Memo(dict):
    """Ids of words; words without any are noted."""

    def __init__(self) -> None:
        super().__init__()
        self.new: set[bytes] = set()

    def __missing__(self, word: bytes) -> bytes:
        self.new.add(word)
        return b""


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in vocabularies on bytes: printable bytes for
    themselves, the others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


def plain_encoding(model: str) -> tuple[tiktoken.Encoding, np.ndarray] | None:
    """An encoding of lines, each a plain word, and which ids end a word.

    A line break takes the place of the mark of a word's end.  None for a tokenizer
    whose merges it could not follow: their order must be that of the ids, after the
    bytes and the bytes that end a word.
    """
    given = json.loads(model)
    bpe, before = given["model"], given.get("pre_tokenizer") or {}
    end = bpe.get("end_of_word_suffix")
    steps = [step["type"] for step in before.get("pretokenizers", [])]
    if bpe["type"] != "BPE" or not end or steps != ["Split", "ByteLevel"] or bpe.get("continuing_subword_prefix"):
        return None
    characters, ranks = byte_characters(), {}
    added = {token["content"] for token in given["added_tokens"]}
    for token, number in bpe["vocab"].items():
        if token in added:
            continue
        body = token.removesuffix(end)
        found = bytes([characters[c] for c in body])
        if b"\n" in found and len(found) > 1:
            return None
        ranks[found + b"\n" * (body != token)] = number
    merges = [m.split(" ") if isinstance(m, str) else m for m in bpe["merges"]]
    singles = sorted(n for found, n in ranks.items() if len(found.removesuffix(b"\n") or found) == 1)
    numbers = [bpe["vocab"][a + b] for a, b in merges]
    if singles != list(range(512)) or numbers != list(range(512, 512 + len(merges))) or len(ranks) != 512 + len(merges):
        return None
    ends = np.zeros(max(ranks.values()) + 1, dtype=bool)
    ends[[n for found, n in ranks.items() if len(found) > 1 and found.endswith(b"\n")]] = True
    return tiktoken.Encoding("lines", pat_str=r"[^\n]+\n", mergeable_ranks=ranks, special_tokens={}), ends


class WordEncoder:
    """Token ids of whole texts, word by word through a memo.

    The tokenizer never joins characters across white space, so a text's ids are
    those of its words.  Where a text is free of special tokens and combining
    marks, A-Z are lowered and marks after a word are split off beforehand; both
    leave the ids as they are and make far fewer different words.

    New words are encoded many at a time.  Plain ones only need the tokenizer's merges,
    which ``plain_encoding`` does; the others go to the tokenizer with a special token
    between them, as a result of its own for each costs more than the encoding.
    """

    def __init__(self, model: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.memo = _Memo()
        self.between = self._separator()
        self.plain = plain_encoding(model)

    def _separator(self) -> tuple[str, int] | None:
        """A special token that parts words without a trace, and its id."""
        for number, token in sorted(self.tokenizer.get_added_tokens_decoder().items()):
            if not token.special or token.normalized or token.single_word or token.lstrip or token.rstrip:
                continue
            words = ["one", "two's", "\u00c9t\u00e9", "4", "!?", "one"]
            own = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
            want = own[0] + [i for ids in own[1:] for i in (number, *ids)]
            if self.tokenizer.encode(token.content.join(words), add_special_tokens=False).ids == want:
                return token.content, number
        return None

    @staticmethod
    def units(text: bytes) -> Iterator[bytes]:
        start = 0
        while len(text) - start > UNIT_BYTES:
            cut = _SPACE.search(text, start + UNIT_BYTES)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    @staticmethod
    def words(text: bytes) -> list[bytes]:
        if b"<|" not in text and b"\xcc" not in text and b"\xcd" not in text:
            text = _TRAILING_MARKS.sub(rb" \g<0>", text.lower())
        return text.split()

    def learn(self, words: list[bytes]) -> None:
        if self.plain is not None:
            encoding, ends = self.plain
            plain = [w for w in words if b"<|" not in w and _PLAIN.fullmatch(w)]
            words = list(set(words).difference(plain))
            ids = encoding.encode_to_numpy("".join([w.decode("utf-8") + "\n" for w in plain])).astype("<u4")
            cuts = ((np.flatnonzero(ends[ids]) + 1) * 4).tolist()
            whole = ids.tobytes()
            self.memo.update(zip(plain, [whole[a:b] for a, b in zip([0, *cuts], cuts)]))
        single = words
        if self.between is not None:
            text, number = self.between
            begin = text[0].encode()
            single = [w for w in words if begin in w]
            joined = [w for w in words if begin not in w]
            groups = [joined[a : a + JOINED_WORDS] for a in range(0, len(joined), JOINED_WORDS)]
            encoded = self.tokenizer.encode_batch(
                [text.join([w.decode("utf-8") for w in g]) for g in groups], add_special_tokens=False
            )
            for group, found in zip(groups, encoded):
                ids = np.asarray(found.ids, dtype="<u4")
                cuts = (np.flatnonzero(ids == number) * 4).tolist()
                whole = ids.tobytes()
                self.memo.update(zip(group, [whole[a:b] for a, b in zip([0, *[c + 4 for c in cuts]], [*cuts, len(whole)])]))
        encoded = self.tokenizer.encode_batch([w.decode("utf-8") for w in single], add_special_tokens=False)
        for word, found in zip(single, encoded):
            self.memo[word] = np.asarray(found.ids, dtype="<u4").tobytes()

    def encode(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """Per text its ids as little-endian unsigned 32-bit numbers."""
        batch: list[tuple[bool, list[bytes]]] = []
        size, done = 0, []
        for text in texts:
            parts = list(self.units(text))
            for k, part in enumerate(parts):
                batch.append((k == len(parts) - 1, self.words(part)))
                size += len(part)
                if size >= UNIT_BYTES:
                    yield from self._flush(batch, done)
                    batch, size = [], 0
        yield from self._flush(batch, done)

    def _flush(self, batch, done: list[bytes]) -> Iterator[bytes]:
        found = self._joined(batch)
        if self.memo.new:
            if len(self.memo) + len(self.memo.new) > MEMO_WORDS:
                self.memo.clear()
                self.memo.new.update(*[words for _, words in batch])
            self.learn(list(self.memo.new))
            self.memo.new.clear()
            found = self._joined(batch)
        for (last, _), ids in zip(batch, found):
            done.append(ids)
            if last:
                yield b"".join(done)
                done.clear()

    def _joined(self, batch) -> list[bytes]:
        return [b"".join(map(self.memo.__getitem__, words)) for _, words in batch]


def encode_pieces(
    docs: DataFrame,
    model: str,
    capacity: int = CAPACITY,
    end_id: int | None = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, ids if wanted.

    ``docs`` has doc_id and text.  A document without any id has no piece.
    """
    name = "encoder_" + hashlib.sha256(model.encode()).hexdigest()
    shared_model = docs.sparkSession.sparkContext.broadcast(model)
    end = b"" if end_id is None else np.asarray([end_id], dtype="<u4").tobytes()
    step = capacity * 4

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = process_memo(name, lambda: WordEncoder(shared_model.value))
        for batch in batches:
            at, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, found in enumerate(encoder.encode(in_turn(batch.column(1)))):
                found += end
                for k, begin in enumerate(range(0, len(found), step)):
                    part = found[begin : begin + step]
                    at.append(row)
                    piece.append(k)
                    start.append(begin // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype="<i4"))
            columns = [
                batch.column(0).take(pa.array(at, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {id_type(docs)}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(
        lean(encode), schema + (", ids array<int>" if with_ids else "")
    )


def best_fit_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, ...]]:
    """Best-fit decreasing over counts of lengths.

    Rows (length, first rank, ranks, first sequence, per sequence, offset): the
    pieces of a length with these ranks fill consecutive sequences, so many in
    each, one behind the other from the offset on.
    """
    plan: list[tuple[int, ...]] = []
    free: dict[int, list[tuple[int, int]]] = {}  # free space -> (first sequence, sequences)
    spaces: list[int] = []
    sequences = 0

    def put(space: int, first: int, n: int) -> None:
        if space and n:
            if space not in free:
                free[space] = []
                bisect.insort(spaces, space)
            free[space].append((first, n))

    def fill(length: int, rank: int, count: int, space: int, first: int) -> int:
        """Put ``count`` pieces into sequences of equal space; the number used."""
        each = space // length
        full, rest = divmod(count, each)
        if full:
            plan.append((length, rank, full * each, first, each, capacity - space))
            put(space - each * length, first, full)
        if rest:
            plan.append((length, rank + full * each, rest, first + full, rest, capacity - space))
            put(space - rest * length, first + full, 1)
        return full + (rest > 0)

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit {capacity}")
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(spaces, length)
            if at == len(spaces):
                sequences += fill(length, rank, left, capacity, sequences)
                break
            space = spaces[at]
            first, n = free[space].pop()
            if not free[space]:
                del free[space], spaces[at]
            count = min(left, n * (space // length))
            used = fill(length, rank, count, space, first)
            put(space, first + used, n - used)
            left, rank = left - count, rank + count
    return plan


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a stored table with doc_id, piece, length) plus sequence_id, offset."""
    histogram = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {row["length"]: row["n"] for row in histogram}
    plan = np.asarray(best_fit_plan(counts, capacity), dtype=np.int64).reshape(-1, 6)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    shared_plan = pieces.sparkSession.sparkContext.broadcast(plan)

    n_slices = max(SLICES, sum(counts.values()) // SLICE_ROWS)
    sliced = pieces.withColumn(
        "pack_slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(n_slices))
    )
    key = ["length", "pack_slice"]
    before = (
        Window.partitionBy("length").orderBy("pack_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = (
        sliced.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        .select(*key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("pack_base"))
    )
    in_slice = Window.partitionBy(*key).orderBy("doc_id", "piece")
    ranked = (
        sliced.withColumn("pack_row", F.row_number().over(in_slice))
        .join(bases, key)
        .withColumn("pack_rank", F.col("pack_base") + F.col("pack_row") - 1)
        .select(*pieces.columns, "pack_rank")
    )
    columns = list(pieces.columns)
    n_columns, at_length = len(columns), columns.index("length")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shared_plan.value
        lengths, begins = rows[:, 0], rows[:, 1]
        span = int((begins + rows[:, 2]).max(initial=0)) + 1
        codes = lengths * span + begins
        for batch in batches:
            length = batch.column(at_length).to_numpy()
            rank = batch.column(n_columns).to_numpy()
            row = rows[np.searchsorted(codes, length * span + rank, side="right") - 1]
            k = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:n_columns],
                    pa.array(row[:, 3] + k // row[:, 4]),
                    pa.array(row[:, 5] + k % row[:, 4] * length),
                ],
                names=[*columns, "sequence_id", "offset"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int | None = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset.

    Each document is its token ids and ``end_id``; documents longer than
    ``capacity`` are cut into pieces of that length, the last may be shorter.
    Null and empty texts are the end id alone.  Rows that repeat an id are
    documents of their own.  Sequences are numbered from 0 and filled from
    offset 0 without gaps.  An empty table gives an empty result; other columns
    are ignored.
    """
    mine = documents(docs, id_col, text_col)
    pieces = encode_pieces(mine, tokenizer_text(tokenizer_path), capacity, end_id, with_ids)
    return pack_pieces(materialize(pieces, "pieces"), capacity)


def packed_sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its token ids, from ``pack_documents(with_ids=True)``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda part: part["ids"])).alias("ids")
    )
