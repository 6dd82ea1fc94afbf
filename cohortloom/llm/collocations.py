"""Phrase collocation mining by dynamic itemset counting.

Phrases are runs of two to LONGEST words inside a piece of text; pieces end at punctuation and line
ends. Everything is counted per language.

Method. The corpus is written as shards and scanned in cycles. In step t shard t % shards is scanned:
words are counted from the start; a longer phrase becomes active once both phrases that it holds, the
one without its last and the one without its first word, have been counted `least` times so far, and is
counted from the next step on until it has met every shard once. So lengths are counted side by side,
and a later cycle is read only for the phrases that became active late. Phrases that can't reach `least`
are never counted, and complete ones below it are dropped at once.

What is active is known to the tasks by the step in which it became so, in one byte for each of `slots`
hash values and each length: tables of a fixed size, whatever the corpus. A slot keeps the first step
that any phrase gave it, so a shared slot lets a phrase start early, alike in all scans: it is counted
without need, never wrongly. With more active phrases than slots the shuffles grow, up to one row a
phrase, chunk and shard; results stay whole. Counts are sums by the phrase's 64-bit hash (which includes
its language and length; two of a billion phrases share one with probability 0.03), combined before
each shuffle, so a phrase of all documents is one row a task.

A last scan reads the words of some occurrences of the phrases that reached `least`, drawn so that each
gives about NAMED rows, and one more scan those of the phrases missed. Each is cut after its first k words; score = floor(scale * a * a / (l * r)) with counts a of the phrase, l and r of its parts, in
38-digit integers (exact below 10^15 words); the cut of the lowest score counts, ties to the smallest k.
A phrase is dropped if a longer one that holds it and reached `least` has at least `covered` percent of
its count. The best `top` of a language are ranked by score, count and phrase (UTF-8 byte order).

Edge cases: null texts are empty, a null language is "und"; texts without words and empty tables give
nothing; repeated rows count each time; columns other than text and language are not read.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import LOWER, batch_of, mix, new_folder, prefix_sums, runs, span_hashes, text_bytes, text_chunks, written

LEAST = 10
LONGEST = 3
SHARDS = 2
#: Hash values told apart in a task's tables, a byte each for every length.
SLOTS = 1 << 24
#: Occurrences of a phrase from which its words are read, on average up to twice as many.
NAMED = 4
CHUNK = 2 << 20

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _BREAK.copy()
_GAP[list(b" \t")] = True
_P = np.uint64(0x9E3779B97F4A7C15)

COUNTS = pa.schema([("length", pa.int32()), ("born", pa.int32()), ("h", pa.int64()), ("c", pa.int64())])
COUNTS_SCHEMA = "length int, born int, h long, c long"


class Pieces:
    """Lower-cased words of some texts and the piece that each belongs to."""

    def __init__(self, text: pa.Array, language: np.ndarray):
        raw, self.offsets = text_bytes(text)
        self.data = LOWER[raw]
        self.starts, self.ends = runs(~_GAP[raw], self.offsets)
        owner = np.searchsorted(self.offsets, self.starts, side="right") - 1
        breaks = np.concatenate(([0], np.cumsum(_BREAK[raw])))
        #: rises at every break and at every text
        self.piece = breaks[self.starts] + owner
        self.language = language[owner]
        self.words = mix(span_hashes(prefix_sums(self.data), self.starts, self.ends) ^ self.language)

    def phrases(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of the phrases of n words, and a hash for every word that n - 1 others follow:
        the phrase's where it begins one."""
        size = max(len(self.words) - n + 1, 0)
        at = np.flatnonzero(self.piece[:size] == self.piece[len(self.piece) - size :])
        with np.errstate(over="ignore"):
            h = self.words[:size]
            for j in range(1, n):
                h = h * _P + self.words[j : size + j]
        return at, h if n == 1 else mix(h ^ np.uint64(n))


def looked_up(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    return table[(h & np.uint64(len(table) - 1)).astype(np.int64)]


def births(pieces: Pieces, tables: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and step of activation (0: not active) of every phrase of n > 1 words."""
    at, h = pieces.phrases(n)
    step = looked_up(tables[n - 2], pieces.phrases(n - 1)[1])
    left, right = step[at], step[at + 1]
    return h[at], np.where((left > 0) & (right > 0), np.maximum(left, right), 0)


def _counted(length: int, born: int, hashes: np.ndarray) -> pa.RecordBatch:
    h, c = np.unique(hashes, return_counts=True)
    return batch_of(COUNTS, length=np.full(len(h), length, np.int32), born=np.full(len(h), born, np.int32), h=h.view(np.int64), c=c)


def _language(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)


def scan(batches: Iterator[pa.RecordBatch], tables: list[np.ndarray], step: int, shards: int) -> Iterator[pa.RecordBatch]:
    """Counts of one step: of languages (length 0) and words in the first cycle, and of active phrases."""
    for batch in batches:
        for part in text_chunks(batch, CHUNK):
            pieces = Pieces(part.column(1), _language(part))
            if step < shards:
                yield _counted(0, 0, pieces.language)
                yield _counted(1, 0, pieces.words)
            for n in range(2, len(tables) + 2):
                h, born = births(pieces, tables, n)
                for b in range(max(1, step - shards + 1), step + 1):
                    if (born == b).any():
                        yield _counted(n, b, h[born == b])


NAMES = pa.schema([("h", pa.int64()), ("language", pa.int64()), ("phrase", pa.string())])
NAMES_SCHEMA = "h long, language long, phrase string"


def name(batches: Iterator[pa.RecordBatch], tables: list[np.ndarray], longest: int) -> Iterator[pa.RecordBatch]:
    """The words of some occurrences of the phrases in the tables: value v gives about one in 2^(v - 1)."""
    draw = np.random.default_rng(TaskContext.get().partitionId())
    for batch in batches:
        for part in text_chunks(batch, CHUNK):
            pieces = Pieces(part.column(1), _language(part))
            text = pieces.data.tobytes()
            for n in range(2, longest + 1):
                at, h = pieces.phrases(n)
                value = looked_up(tables[n - 2], h[at])
                at = at[(value > 0) & (draw.random(len(at)) < 0.5 ** (value - 1.0))]
                found, first = np.unique(h[at], return_index=True)
                at = at[first]
                words = [[text[s:e] for s, e in zip(pieces.starts[at + j].tolist(), pieces.ends[at + j].tolist())] for j in range(n)]
                phrase = pa.array([b" ".join(w) for w in zip(*words)], pa.binary()).cast(pa.string())
                if len(at):
                    yield batch_of(NAMES, h=found.view(np.int64), language=pieces.language[at].view(np.int64), phrase=phrase)


PARTS = "h long, length int, language long, phrase string, a long, lefts array<long>, rights array<long>, inner array<long>"


def cut_parts(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[pa.RecordBatch]:
    """To every phrase the hashes of both parts of each cut and of the phrases one word shorter."""
    for batch in batches:
        lengths = batch.column(1).to_numpy(zero_copy_only=False)
        for n in np.unique(lengths):
            part = batch.filter(pa.array(lengths == n))
            pieces = Pieces(part.column(3), part.column(2).to_numpy(zero_copy_only=False).view(np.uint64))
            of = [pieces.phrases(k)[1] for k in range(1, n)]
            at = np.arange(part.num_rows) * n
            sides = (
                [of[k - 1][at] for k in range(1, n)],
                [of[n - k - 1][at + k] for k in range(1, n)],
                [of[n - 2][at], of[n - 2][at + 1]],
            )
            yield pa.RecordBatch.from_arrays([*part.columns, *map(_lists, sides)], names=[*part.schema.names, "lefts", "rights", "inner"])


def _lists(parts: list[np.ndarray]) -> pa.Array:
    rows = np.stack(parts, axis=1).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))


def mark(table: np.ndarray, hashes: DataFrame, value: Column) -> int:
    """Give each free slot of the hashes h its least value; returns how many. Bits reach the driver,
    one a slot and value."""
    slot = F.col("h").bitwiseAND(F.lit(len(table) - 1)) + 1
    bits = hashes.select(slot.alias("slot"), value.cast("int").alias("value")).groupBy("value", F.expr("bitmap_bucket_number(slot)").alias("bucket"))
    fresh = 0
    for row in sorted(bits.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits")).collect()):
        held = np.unpackbits(np.frombuffer(row.bits, np.uint8), bitorder="little").astype(bool)
        part = table[(row.bucket - 1) * len(held) :][: len(held)]
        free = held[: len(part)] & (part == 0)
        part[free] = row.value
        fresh += int(free.sum())
    return fresh


def sharded(docs: DataFrame, text: str, language: str, shards: int) -> DataFrame:
    """Texts and language hashes, written as one folder a shard."""
    rows = docs.select(
        F.xxhash64(F.coalesce(F.col(language).cast("string"), F.lit("und"))).alias("language"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int"))
    path = new_folder(docs.sparkSession, "shards")
    rows.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def count_phrases(corpus: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(length, h, c) of all languages (length 0), words and phrases counted `least` times or more."""
    context = corpus.sparkSession.sparkContext
    tables = [np.zeros(slots, np.uint8) for _ in range(longest - 1)]
    complete, state, step, latest = [], None, 0, 0
    while step < max(shards, latest + shards):
        shared = context.broadcast(tables)
        shard = corpus.where(F.col("shard") == step % shards).select("language", "text")
        rows = shard.mapInArrow(lambda it, b=shared, t=step: scan(it, b.value, t, shards), COUNTS_SCHEMA)
        both = rows if state is None else rows.union(state)
        summed = both.groupBy("length", "born", "h").agg(F.sum("c").alias("c"))
        ended = F.col("born") + shards - 1 <= step
        counts = written(summed.where((F.col("c") >= least) | ~ended), f"counts-{step}")
        shared.destroy()
        complete.append(counts.where(ended).select("length", "h", "c"))
        state = counts.where(~ended)
        step += 1
        for n in range(1, longest):
            if mark(tables[n - 1], counts.where((F.col("length") == n) & (F.col("c") >= least)), F.lit(step)):
                latest = step
    return written(reduce(DataFrame.union, complete), "phrase-counts")


def name_phrases(corpus: DataFrame, counts: DataFrame, longest: int = LONGEST, slots: int = SLOTS) -> DataFrame:
    """The counted phrases with their words and parts. Of a phrase counted a times about NAMED
    occurrences are read, whatever a is; the few phrases missed so are read in full."""
    context = corpus.sparkSession.sparkContext
    missing = counts.where("length > 1").select("h", "length", F.col("c").alias("a"))
    share, found = F.greatest(F.lit(0), F.floor(F.log2(F.col("a") / NAMED))) + 1, []
    while not missing.isEmpty():
        tables = [np.zeros(slots, np.uint8) for _ in range(longest - 1)]
        for n in range(2, longest + 1):
            mark(tables[n - 2], missing.where(F.col("length") == n), share)
        shared = context.broadcast(tables)
        rows = corpus.select("language", "text").mapInArrow(lambda it, b=shared: name(it, b.value, longest), NAMES_SCHEMA)
        found.append(written(rows.join(missing, "h").dropDuplicates(["h"]).select("h", "length", "language", "phrase", "a"), "names"))
        shared.destroy()
        missing, share = written(missing.join(found[-1], "h", "left_anti"), "missing"), F.lit(1)
    if not found:
        found = [missing.select("h", "length", F.col("h").alias("language"), F.lit("").alias("phrase"), "a")]
    return written(reduce(DataFrame.union, found).mapInArrow(lambda it: cut_parts(it, longest), PARTS), "phrases")


def collocations(
    docs: DataFrame, text: str = "text", language: str = "lang", least: int = LEAST, longest: int = LONGEST,
    top: int = 2000, scale: int = 1_000_000, covered: int = 50, shards: int = SHARDS, slots: int = SLOTS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best `top` phrases of each language."""
    if not 1 <= shards <= 80:
        raise ValueError("shards must be between 1 and 80: steps are kept in a byte")
    corpus = sharded(docs, text, language, shards)
    counts = count_phrases(corpus, least, longest, shards, slots)
    phrases = name_phrases(corpus, counts, longest, slots)

    parts = counts.where((F.col("length") > 0) & (F.col("length") < longest)).select("h", "c")
    cut = phrases.select("h", "a", F.posexplode(F.arrays_zip("lefts", "rights")).alias("k", "cut")).select("h", "a", "k", "cut.*")
    cut = cut.join(parts.select(F.col("h").alias("lefts"), F.col("c").alias("l")), "lefts")
    cut = cut.join(parts.select(F.col("h").alias("rights"), F.col("c").alias("r")), "rights")
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    exact = cut.withColumns({"x": wide("a") * wide("a") * F.lit(scale).cast("decimal(8,0)"), "y": wide("l") * wide("r")})
    score = exact.select("h", F.struct(F.expr("x div y").alias("score"), "k", "l", "r").alias("cut")).groupBy("h").agg(F.min("cut").alias("cut"))

    longer = phrases.where("length > 2").select(F.explode("inner").alias("h"), F.col("a").alias("longer"))
    longer = longer.groupBy("h").agg(F.max("longer").alias("longer"))
    kept = phrases.join(longer, "h", "left").where(F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True)))

    names = docs.select(F.coalesce(F.col(language).cast("string"), F.lit("und")).alias("lang")).distinct()
    totals = counts.where("length = 0").select(F.col("h").alias("language"), F.col("c").alias("n"))
    totals = totals.join(names.withColumn("language", F.xxhash64("lang")), "language")
    scored = kept.join(score, "h").join(totals, "language").select("lang", "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # a language may hold most phrases: its best of every part first
    parts = F.pmod(F.xxhash64("phrase"), F.lit(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    place = F.row_number().over(Window.partitionBy("lang", parts).orderBy(*order))
    best = scored.withColumn("place", place).where(F.col("place") <= top).drop("place")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
