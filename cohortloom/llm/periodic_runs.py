"""Periodic run detection: maximal stretches of words that repeat with a period.

A run is a stretch of consecutive words with smallest period q, at least max(MIN_LENGTH, REPEATS * q)
words long, that no neighbouring word extends keeping the period.

Method. Words are 64-bit hashes in one array, texts parted by a mark found nowhere else.
* Periods below SCALE are scanned directly: words 8 apart are compared with the word a lag behind; where
  two such places and all between agree, a stretch is found, because every run of these periods agrees
  with itself at the lag for 16 words or more.
* Scale k (SCALE, 2 SCALE, ...) covers periods of k to 2k - 1. Every window of k successive k-word
  grams has a minimizer, the leftmost gram of least hash. Inside a run the windows repeat at period
  distance and so do their minimizers: equal minimizers k to 2k - 1 words apart are seeds. Grams that
  are themselves repetitive (inside a known run of period up to k / 3) take no part; a run of a period
  of k or more always has others, and equal ones lie more than k / 3 apart, so a gram meets few partners.
* Seeds are extended both ways by binary search over running hashes and compared word by word; where the
  hashes misled, the lag is scanned in that text. A stretch inside a run of a smaller period has a
  smaller period itself and is dropped.

Work is n log n in the words of a text, whatever its repetitions. Texts are handled in chunks of about
1 MB, a longer text by itself; there is no shuffle.

collapsed keeps the words that no run contains after its first period, joined by one space.

Edge cases: null and empty texts have no words, no runs and an empty collapsed text; ties in
length/period go to the smallest start, then period (best_run); every row gives a row, repeated rows
included; an empty table gives none; other columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import mix, prefix_sums, runs, span_hashes, text_chunks

MIN_LENGTH = 24
REPEATS = 3
#: The first scale of minimizers; smaller periods are scanned lag by lag.
SCALE = 32
STEP = 8

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_P = np.uint64(0x9E3779B97F4A7C15)

RUNS_SCHEMA = "array<struct<start: long, length: long, period: long>>"


class Sequence:
    """Words as 64-bit numbers with running hashes, so that spans are compared in constant time."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        n = len(ids)
        with np.errstate(over="ignore"):
            self.up = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, _P))))
            down = np.uint64(pow(int(_P), -1, 1 << 64))
            self.down = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, down))))
            self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(ids) * self.up[:n])))

    def spans(self, start: np.ndarray, length) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[start + length] - self.sums[start]) * self.down[start])

    def extend(self, at: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The stretches [start, end) around the places at and at + lag that agree at the lag."""
        back, ahead = np.zeros_like(at), np.zeros_like(at)
        step = 1 << len(self.ids).bit_length()
        while step:
            can = np.flatnonzero(at + lag + ahead + step <= len(self.ids))
            i = at[can] + ahead[can]
            ahead[can[self.spans(i, step) == self.spans(i + lag[can], step)]] += step
            can = np.flatnonzero(at - back - step >= 0)
            i = at[can] - back[can] - step
            back[can[self.spans(i, step) == self.spans(i + lag[can], step)]] += step
            step >>= 1
        return at - back, at + lag + ahead


def _lag_scan(ids: np.ndarray, lo: int, hi: int, lag: int) -> tuple[np.ndarray, np.ndarray]:
    """All stretches of ids[lo:hi] that agree at the lag, word by word."""
    if hi - lo <= lag:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts, ends = runs(ids[lo : hi - lag] == ids[lo + lag : hi], np.array([0, hi - lo - lag]))
    return starts + lo, ends + lo + lag


class Found:
    """The runs known so far, of all periods up to the one at work."""

    def __init__(self, n: int, least: int, repeats: int):
        self.n, self.least, self.repeats = n, least, repeats
        self.start = self.end = self.period = np.zeros(0, np.int64)

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        """Keep the long enough stretches that no known run of a smaller period holds."""
        long = end - start >= np.maximum(self.least, self.repeats * period)
        rows = np.unique(np.stack((start[long], end[long], period[long])), axis=1) if long.any() else np.zeros((3, 0), np.int64)
        if rows.shape[1] and len(self.start):
            order = np.argsort(self.start, kind="stable")
            reach = np.maximum.accumulate(self.end[order])
            before = np.searchsorted(self.start[order], rows[0], side="right") - 1
            rows = rows[:, (before < 0) | (reach[np.maximum(before, 0)] < rows[1])]
        self.start = np.concatenate((self.start, rows[0]))
        self.end = np.concatenate((self.end, rows[1]))
        self.period = np.concatenate((self.period, rows[2]))

    def covered(self, k: int) -> np.ndarray:
        """True where a gram of k words begins that lies inside a run of a period up to k / 3."""
        depth = np.zeros(self.n + 1, np.int32)
        use = (self.period * 3 <= k) & (self.end - self.start >= k)
        np.add.at(depth, self.start[use], 1)
        np.add.at(depth, self.end[use] - k + 1, -1)
        return np.cumsum(depth[:-1]) > 0


def _exact(seq: Sequence, bounds: np.ndarray, start: np.ndarray, end: np.ndarray, lag: np.ndarray, least: int, repeats: int):
    """The long stretches, compared word by word. Where the hashes misled, the lag is scanned."""
    long = end - start >= np.maximum(least, repeats * lag)
    rows = np.unique(np.stack((lag[long], start[long], end[long])), axis=1) if long.any() else np.zeros((3, 0), np.int64)
    out = []
    for q, a, b in rows.T:
        if np.array_equal(seq.ids[a : b - q], seq.ids[a + q : b]):
            out.append((a, b, q))
        else:
            k = np.searchsorted(bounds, a, side="right") - 1
            out += [(x, y, q) for x, y in zip(*_lag_scan(seq.ids, int(bounds[k]), int(bounds[k + 1]) - 1, int(q)))]
    found = np.array(out, np.int64).reshape(-1, 3).T
    return found[0], found[1], found[2]


def _short_seeds(seq: Sequence, lag: int) -> np.ndarray:
    """Places from which STEP words and the next agree at the lag, one of each unbroken row of them."""
    ids, n = seq.ids, len(seq.ids)
    same = ids[: max(n - lag, 0) : STEP] == ids[lag::STEP][: len(range(0, max(n - lag, 0), STEP))]
    at = np.flatnonzero(same[:-1] & same[1:]) * STEP
    at = at[seq.spans(at, STEP) == seq.spans(at + lag, STEP)]
    return at[np.append(True, np.diff(at) > STEP)] if len(at) else at


def minimizers(grams: np.ndarray, usable: np.ndarray, window: int) -> np.ndarray:
    """Places of the leftmost least usable gram of every window; window is a power of two."""
    if len(grams) < window:
        return np.zeros(0, np.int64)
    last = np.uint64(0xFFFFFFFFFFFFFFFF)
    value = np.where(usable, grams, last)
    place = np.arange(len(grams))
    step = 1
    while step < window:
        right = value[step:] < value[:-step]
        place = np.where(right, place[step:], place[:-step])
        value = np.where(right, value[step:], value[:-step])
        step *= 2
    place = place[np.append(True, place[1:] != place[:-1])] if len(place) else place
    return np.unique(place[usable[place]])


def _pairs(seq: Sequence, k: int, covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of equal minimizers k to 2k - 1 words apart."""
    n = len(seq.ids) - k + 1
    grams = seq.spans(np.arange(n), k)
    at = minimizers(grams, ~covered[:n], k)
    order = np.lexsort((at, grams[at]))
    at, value = at[order], grams[at][order]
    places, lags = [], []
    step = 1
    left = np.arange(len(at))
    while len(left):
        left = left[left + step < len(at)]
        left = left[(value[left + step] == value[left]) & (at[left + step] - at[left] < 2 * k)]
        lag = at[left + step] - at[left]
        places.append(at[left[lag >= k]])
        lags.append(lag[lag >= k])
        step += 1
    return np.concatenate(places or [at[:0]]), np.concatenate(lags or [at[:0]])


def find(ids: np.ndarray, bounds: np.ndarray, least: int = MIN_LENGTH, repeats: int = REPEATS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs. Text i is ids[bounds[i] : bounds[i + 1] - 1], and the place
    behind it holds a number found nowhere else. least is 24 or more, repeats 3 or more."""
    if least < 24 or repeats < 3:
        raise ValueError("runs shorter than 24 words or three periods are not searched")
    if len(ids) < least:
        return (np.zeros(0, np.int64),) * 3
    seq, found = Sequence(ids), Found(len(ids), least, repeats)
    longest = int(np.diff(bounds).max()) - 1
    seeds = [_short_seeds(seq, lag) for lag in range(1, min(SCALE, longest // repeats + 1))]
    lags = np.repeat(np.arange(1, len(seeds) + 1), [len(at) for at in seeds])
    if len(lags):
        start, end, period = _exact(seq, bounds, *seq.extend(np.concatenate(seeds), lags), lags, least, repeats)
        for lag in np.unique(period):
            own = period == lag
            found.add(start[own], end[own], period[own])
    k = SCALE
    while repeats * k <= longest:
        # only the texts long enough for a run of this scale
        use = np.flatnonzero(np.diff(bounds) - 1 >= repeats * k)
        keep = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in use])
        part = Sequence(ids[keep]) if len(keep) < len(ids) else seq
        at, lags = _pairs(part, k, found.covered(k)[keep])
        if len(at):
            inner = np.concatenate(([0], np.cumsum(np.diff(bounds)[use])))
            start, end, period = _exact(part, inner, *part.extend(at, lags), lags, least, repeats)
            found.add(keep[start], keep[end - 1] + 1, period)
        k *= 2
    order = np.lexsort((found.period, found.start))
    return found.start[order], found.end[order], found.period[order]


class SpacedWords:
    """Words of some texts, parted by white space; texts are parted by a line feed."""

    def __init__(self, text: pa.Array):
        values = [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in text.cast(pa.large_binary())]
        self.bytes = b"\n".join(values) + b"\n"
        raw = np.frombuffer(self.bytes, np.uint8)
        offsets = np.concatenate(([0], np.cumsum([len(v) + 1 for v in values]))).astype(np.int64)
        self.starts, self.ends = runs(~_SPACE[raw], offsets)
        self.first = np.searchsorted(self.starts, offsets)
        self.hashes = span_hashes(prefix_sums(raw), self.starts, self.ends)

    def sequence(self) -> tuple[np.ndarray, np.ndarray]:
        """ids and bounds for find(): a mark of its own behind each text."""
        texts = len(self.first) - 1
        bounds = self.first + np.arange(texts + 1)
        ids = np.empty(len(self.hashes) + texts, np.uint64)
        marks = np.ones(len(ids), bool)
        marks[bounds[1:] - 1] = False
        ids[marks] = self.hashes | np.uint64(1)
        ids[~marks] = np.arange(texts, dtype=np.uint64) << np.uint64(1)  # even, so no word's number
        return ids, bounds

    def joined(self, text: int, keep: np.ndarray) -> bytes:
        a = self.first[text]
        at = np.flatnonzero(keep) + a
        return b" ".join([self.bytes[s:e] for s, e in zip(self.starts[at].tolist(), self.ends[at].tolist())])


def _rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    words = SpacedWords(batch.column(1))
    ids, bounds = words.sequence()
    start, end, period = find(ids, bounds)
    owner = np.searchsorted(bounds, start, side="right") - 1
    depth = np.zeros(len(ids) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, end, -1)
    keep = np.cumsum(depth[:-1]) == 0
    collapsed = [words.joined(i, keep[bounds[i] : bounds[i + 1] - 1]) for i in range(batch.num_rows)]
    offsets = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
    entries = pa.StructArray.from_arrays(
        [pa.array(start - bounds[owner]), pa.array(end - start), pa.array(period)], names=["start", "length", "period"]
    )
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(np.diff(words.first)), pa.ListArray.from_arrays(pa.array(offsets), entries), pa.array(collapsed, pa.binary()).cast(pa.string())],
        names=["id", "n_words", "runs", "collapsed"],
    )


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_chunks(batch):
            yield _rows(part)


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_words, runs (by start, then period), collapsed (the text without repetitions)."""
    kind = docs.select(F.col(key)).schema[0].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    out = rows.mapInArrow(_scan, f"id {kind}, n_words long, runs {RUNS_SCHEMA}, collapsed string")
    return out.withColumnRenamed("id", key)


def best_run(found: Column) -> Column:
    """The run of greatest exact length / period; ties: smallest start, then period. Null without runs."""
    wins = lambda x, y: (x["length"] * y["period"] > y["length"] * x["period"]) | (
        (x["length"] * y["period"] == y["length"] * x["period"])
        & ((x["start"] < y["start"]) | ((x["start"] == y["start"]) & (x["period"] < y["period"])))
    )
    return F.reduce(found, F.try_element_at(found, F.lit(1)), lambda best, x: F.when(wins(x, best), x).otherwise(best))


def runs_text(found: Column) -> Column:
    """start,length,period and a line feed for every run."""
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return F.array_join(F.transform(found, line), "")
