"""Statistics of several features from one scan.

A ``Request`` says which cells of a row it wants counted: a key and perhaps a
number.  ``gather`` explodes each row into the cells of all requests, adds them up
by (request, key) and stores the sums, so a scan of the input serves any number of
requests.  Partial sums merge before the shuffle: a hot key arrives as one row per
task.  A request may ask for another round once it has seen its sums.

* ``GroupCounts`` counts combinations of columns, for modes per group.
* ``NumberStats`` finds moments and exact quantiles.  The first round counts values
  by ``bucket``, a 256th of an octave; that yields the moments and the buckets that
  hold the wanted ranks.  The second counts the values in these buckets, which are
  then closed in on in the stored sums.

A feature that returns ``Deferred`` has its requests gathered along with those of
other features.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort.functions.values import nan_to_null, quoted, to_number
from cohort.plans.workspace import materialize

FETCH_ROWS = 100_000
#: Parts of an interval that holds more values than that, and intervals looked at in one pass.
PARTS, INTERVALS_PER_PASS = 4_096, 64
#: Buckets per unit of ln|x|, what keeps them positive, and the place of infinity.
_PER_LOG, _SHIFT, _INFINITE = 256 / math.log(2), 300_000, 800.0
_AT, _X, _MANY = "_cohort_at", "_cohort_x", "_cohort_numbers"


@dataclass(frozen=True)
class Cell:
    """What a row adds to a request: a key, a number, and whether it adds anything."""

    key: Column
    x: Column | None = None
    where: Column | None = None


class Request:
    #: The columns of the table that the request reads.
    columns: Sequence[str] = ()
    settled = False

    def cells(self, df: DataFrame) -> list[Cell]:
        return []

    def numbers(self, df: DataFrame) -> list[Column]:
        """Doubles of a row that ``number_cell`` gives a key, instead of ``cells``."""
        return []

    def number_cell(self, at: Column, x: Column) -> Cell:
        """The cell of the number ``x`` that stands at ``at`` in ``numbers``."""
        raise NotImplementedError

    def take(self, sums: DataFrame) -> None:
        """Fields of the key and n, low, high, total, var of each key, stored."""
        raise NotImplementedError


def gather(df: DataFrame, requests: Sequence[Request]) -> None:
    """Rounds until all requests are settled."""
    while pending := [r for r in requests if not r.settled]:
        gather_round(df, pending)


def gather_round(df: DataFrame, requests: Sequence[Request]) -> None:
    """One scan of ``df`` for all requests."""
    made = {i: cells for i, r in enumerate(requests) if (cells := r.cells(df))}
    numbers = {i: found for i, r in enumerate(requests) if (found := r.numbers(df))}
    late = {i: requests[i].number_cell(F.col(_AT), F.col(_X)) for i in numbers}
    probes = {i: df.select(cells[0].key.alias("key")) for i, cells in made.items()}
    pairs = df.select(F.lit(0).alias(_AT), F.lit(0.0).alias(_X))
    probes.update({i: pairs.select(cell.key.alias("key")) for i, cell in late.items()})
    # Keys field by field: Spark's fast hash map takes no structs.  Types as text have
    # no word of nulls, which cells of one request may differ in.
    fields = {
        i: [(f.name, f"g{i}_{k}", f.dataType.simpleString()) for k, f in enumerate(probe.schema["key"].dataType.fields)]
        for i, probe in probes.items()
    }
    keys = [column for own in fields.values() for _, column, _ in own]
    none = F.lit(None)

    def entry(i: int, key: Column | None, x: Column | None, many: Column = none) -> Column:
        parts = [
            (none if key is None or j != i else key[name]).cast(kind).alias(column)
            for j, own in fields.items()
            for name, column, kind in own
        ]
        x = (none if x is None else x).cast("double").alias("x")
        return F.struct(F.lit(i).alias("request"), *parts, x, many.cast("array<double>").alias(_MANY))

    entries = [entry(i, None, None, F.array(*xs)) for i, xs in numbers.items()]
    for i, cells in made.items():
        for cell in cells:
            one = entry(i, cell.key, cell.x)
            entries.append(one if cell.where is None else F.when(cell.where, one))
    rows = df.select(F.inline(F.array(*entries))).where("request is not null")
    if late:
        rows = rows.select("request", *keys, "x", F.posexplode_outer(_MANY).alias(_AT, _X))
        keyed = {}
        for i, cell in late.items():
            own = F.col("request") == i
            if cell.where is not None:
                rows = rows.where(~own | cell.where)
            keyed.update({c: F.when(own, cell.key[name]).cast(kind) for name, c, kind in fields[i]})
        rows = rows.select("request", *[keyed.get(c, F.col(c)).alias(c) for c in keys], F.coalesce(_X, "x").alias("x"))
    sums = rows.groupBy("request", *keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"),
        F.sum("x").alias("total"), F.var_pop("x").alias("var"),
    )
    stored = materialize(sums, "statistics")
    for i, r in enumerate(requests):
        own = [F.col(column).alias(name) for name, column, _ in fields.get(i, [])]
        r.take(stored.where(F.col("request") == i).select(*own, "n", "low", "high", "total", "var"))


@dataclass
class Deferred:
    """A feature whose statistics are still to be gathered.

    ``build`` makes the fitted transform of the settled requests.  ``early`` adds
    those of its columns that need no statistics, so that others may use them.
    """

    requests: Sequence[Request]
    build: Callable[[], Any]
    early: Callable[[DataFrame], DataFrame] | None = None

    @property
    def settled(self) -> bool:
        return all(r.settled for r in self.requests)

    def now(self, df: DataFrame) -> Any:
        gather(df, self.requests)
        return self.build()


# --- counts ------------------------------------------------------------------


class GroupCounts(Request):
    """How often each combination of ``columns`` occurs; NaN counts as missing."""

    def __init__(self, columns: Sequence[str]) -> None:
        self.columns = list(columns)
        self.counts: DataFrame | None = None

    def cells(self, df: DataFrame) -> list[Cell]:
        def clean(name: str) -> Column:
            real = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
            return nan_to_null(quoted(name)) if real else quoted(name)

        return [Cell(F.struct(*[clean(c).alias(f"c{k}") for k, c in enumerate(self.columns)]))]

    def take(self, sums: DataFrame) -> None:
        names = [F.col(f"c{k}").alias(c) for k, c in enumerate(self.columns)]
        self.counts, self.settled = sums.select(*names, "n"), True


# --- numbers -----------------------------------------------------------------


@dataclass
class NumberSummary:
    """Statistics of one column; quantiles are keyed by probability."""

    rows: int
    present: int
    low: float | None
    high: float | None
    mean: float | None
    var_pop: float | None
    quantiles: dict[float, float | None] = field(default_factory=dict)

    @property
    def missing(self) -> int:
        return self.rows - self.present

    @property
    def infinite(self) -> bool:
        return bool(self.present) and math.inf in (-self.low, self.high)

    @property
    def std_samp(self) -> float | None:
        """Sample deviation; None for fewer than two values."""
        if self.present < 2:
            return None
        return math.sqrt(self.var_pop * self.present / (self.present - 1))


@dataclass
class _Rank:
    """A wanted rank: the ``offset``-th of the ``n`` values from ``low`` to ``high``."""

    place: int
    rank: int
    low: float
    high: float
    offset: int
    n: int

    @property
    def found(self) -> bool:
        return self.low == self.high

    @property
    def interval(self) -> tuple[int, float, float]:
        return self.place, self.low, self.high

    def close_in(self, low: float, high: float, before: int, n: int) -> None:
        self.low, self.high, self.offset, self.n = low, high, self.offset - before, n


def bucket(x: Column) -> Column:
    """A number's place in a fixed scale; it grows with the number."""
    size = F.floor(F.least(F.ln(F.abs(x)), F.lit(_INFINITE)) * _PER_LOG) + _SHIFT
    return F.when(x == 0, F.lit(0).cast("long")).when(x > 0, size).when(x < 0, -size)


class NumberStats(Request):
    """Moments and exact quantiles of ``columns``, in ``summaries`` by name."""

    def __init__(
        self, columns: Sequence[str], probabilities: Sequence[float] = (), fetch_rows: int = FETCH_ROWS
    ) -> None:
        self.columns = list(columns)
        self.probabilities = list(probabilities)
        self.fetch_rows = fetch_rows
        self.summaries: dict[str, NumberSummary] = {}
        self._ranks: dict[tuple[int, int], _Rank] = {}
        self.settled = not self.columns

    def _asked(self) -> list[int]:
        """Places of the columns that this round reads."""
        if not self.summaries:
            return list(range(len(self.columns)))
        return sorted({r.place for r in self._open()})

    def numbers(self, df: DataFrame) -> list[Column]:
        names = [self.columns[place] for place in self._asked()]
        return [to_number(quoted(name), df.schema[name].dataType).cast("double") for name in names]

    def number_cell(self, at: Column, x: Column) -> Cell:
        asked = self._asked()
        place = F.get(F.array(*[F.lit(p) for p in asked]), at)
        if not self.summaries:
            return Cell(F.struct(place.alias("place"), bucket(x).alias("at")), x)
        inside = F.lit(False)
        for p, low, high in sorted({r.interval for r in self._open()}):
            inside = inside | ((at == asked.index(p)) & (x >= low) & (x <= high))
        return Cell(F.struct(place.alias("place"), x.alias("at")), where=F.coalesce(inside, F.lit(False)))

    def _open(self) -> list[_Rank]:
        return [r for r in self._ranks.values() if not r.found]

    def take(self, sums: DataFrame) -> None:
        if not self.summaries:
            self._summarise(sums)
        else:
            self._close_in(sums)
        if not self._open():
            self._finish()

    def _summarise(self, sums: DataFrame) -> None:
        """Moments, and for each wanted rank the bucket that it lies in."""
        whole = Window.partitionBy("place")
        n = F.col("n")
        known = F.when(F.col("at").isNotNull(), n)
        mean = F.col("total") / n
        rows = (
            sums.withColumns({
                "rows": F.sum("n").over(whole), "present": F.coalesce(F.sum(known).over(whole), F.lit(0)),
                "upto": F.coalesce(F.sum(known).over(whole.orderBy("at")), F.lit(0)),
                "sum": F.sum("total").over(whole), "least": F.min("low").over(whole), "most": F.max("high").over(whole),
                "first": F.row_number().over(whole.orderBy("at")) == 1,
            })
            .withColumn("mean", F.when(F.col("present") > 0, F.col("sum") / F.when(F.col("present") > 0, F.col("present"))))
            .withColumn("squares", F.sum(n * (F.col("var") + (mean - F.col("mean")) * (mean - F.col("mean")))).over(whole))
        )
        # Ranks are counted from 0: a bucket holds those from upto - n to upto - 1.
        holds = F.lit(False)
        if self.probabilities:
            at = F.array(*[F.lit(float(p)) for p in self.probabilities])

            def inside(rank: Column) -> Column:
                return (rank >= F.col("upto") - n) & (rank < F.col("upto"))

            def hit(p: Column) -> Column:
                exact = p * (F.col("present") - 1)
                return inside(F.floor(exact)) | inside(F.ceil(exact))

            holds = F.col("at").isNotNull() & F.exists(at, hit)
        found: dict[int, list] = {}
        for r in rows.where(F.col("first") | holds).collect():
            found.setdefault(r["place"], []).append(r)
        for place, name in enumerate(self.columns):
            own = found.get(place)
            if own is None:
                self.summaries[name] = NumberSummary(0, 0, None, None, None, None)
                continue
            r = own[0]
            var = r["squares"] / r["present"] if r["present"] else None
            self.summaries[name] = s = NumberSummary(r["rows"], r["present"], r["least"], r["most"], r["mean"], var)
            for rank in self._wanted(s):
                if rank in (0, s.present - 1):
                    edge = s.low if rank == 0 else s.high
                    self._ranks[place, rank] = _Rank(place, rank, edge, edge, 0, 1)
                    continue
                b = next(b for b in own if b["at"] is not None and b["upto"] - b["n"] <= rank < b["upto"])
                self._ranks[place, rank] = _Rank(place, rank, b["low"], b["high"], rank - b["upto"] + b["n"], b["n"])

    def _wanted(self, s: NumberSummary) -> set[int]:
        exact = [p * (s.present - 1) for p in self.probabilities if s.present]
        return {math.floor(x) for x in exact} | {math.ceil(x) for x in exact}

    def _close_in(self, values: DataFrame) -> None:
        """Cut large intervals into parts until few enough values are left to rank."""
        while many := [r for r in self._open() if r.n > self.fetch_rows]:
            for some in _chunks(many):
                _locate(values, some, PARTS)
        for some in _chunks(self._open()):
            _locate(values, some, None)

    def _finish(self) -> None:
        for place, name in enumerate(self.columns):
            s = self.summaries[name]
            for p in self.probabilities:
                if not s.present:
                    s.quantiles[p] = None
                    continue
                position = p * (s.present - 1)
                lower, upper = math.floor(position), math.ceil(position)
                a, b = self._ranks[place, lower].low, self._ranks[place, upper].low
                # Interpolating between equal values would round.
                s.quantiles[p] = a if a == b else (upper - position) * a + (position - lower) * b
        self.settled = True


def _locate(values: DataFrame, ranks: list[_Rank], parts: int | None) -> None:
    """The part of its interval, or the value itself, that each rank lies in."""
    intervals = sorted({r.interval for r in ranks})
    number = {interval: i for i, interval in enumerate(intervals)}
    listed = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(p).alias("p"), F.lit(a).alias("a"), F.lit(b).alias("b"))
        for i, (p, a, b) in enumerate(intervals)
    ])
    x = F.col("at")
    met = values.select(
        "at", "n",
        F.inline(F.filter(listed, lambda v: (v["p"] == F.col("place")) & (x >= v["a"]) & (x <= v["b"]))),
    )
    part = x
    if parts is not None:
        part = F.least(F.floor((x - F.col("a")) / (F.col("b") - F.col("a")) * parts), F.lit(parts - 1).cast("long"))
    sums = met.groupBy("i", part.alias("part")).agg(
        F.sum("n").alias("n"), F.min("at").alias("low"), F.max("at").alias("high")
    )
    upto = F.sum("n").over(Window.partitionBy("i").orderBy("part"))
    wanted = F.array(*[
        F.struct(F.lit(number[r.interval]).alias("i"), F.lit(r.offset).cast("long").alias("offset")) for r in ranks
    ])
    hit = F.exists(
        wanted,
        lambda w: (w["i"] == F.col("i")) & (w["offset"] >= F.col("upto") - F.col("n")) & (w["offset"] < F.col("upto")),
    )
    rows = sums.withColumn("upto", upto).where(hit).collect()
    for r in ranks:
        i = number[r.interval]
        b = next(b for b in rows if b["i"] == i and b["upto"] - b["n"] <= r.offset < b["upto"])
        r.close_in(b["low"], b["high"], b["upto"] - b["n"], b["n"])


def _chunks(ranks: list[_Rank]) -> Iterable[list[_Rank]]:
    """Ranks of up to so many intervals at a time."""
    intervals = sorted({r.interval for r in ranks})
    for start in range(0, len(intervals), INTERVALS_PER_PASS):
        some = set(intervals[start : start + INTERVALS_PER_PASS])
        yield [r for r in ranks if r.interval in some]
