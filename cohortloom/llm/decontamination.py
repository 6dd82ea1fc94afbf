"""Benchmark decontamination: Wu-Manber search for every window of every benchmark item.

Method. Words are the alphabet. All windows of one length are searched together: a shift table,
indexed by the hash of a block of two words, tells how far a cursor may jump because no window
holds that block nearer to its end; where the shift is zero, the hash of the block selects the
windows that end in it, and a direct comparison of the words confirms an occurrence. Many cursors,
each for a stretch of a text, move in step (numpy).

The benchmark is the query set. It is read in blocks of at most BLOCK_BYTES of text; a block's
tables are broadcast, so their size is bounded whatever the benchmark. With more than one block the
hit words of a document are united by a group-by.

Edge cases: a null or empty text has no words and is clean; an item without words, or with a null
id, takes no part; items with the same id count as one; repeated documents give repeated rows;
an empty benchmark leaves every document clean.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import Words, batch_of, code_points, fresh, mix, text_chunks, written

WINDOW = 13
#: Text of the benchmark items that are searched in one pass over the documents.
BLOCK_BYTES = 2 << 20
#: Entries of a shift table.
SHIFTS = 1 << 20
#: A document is contaminated if one word in so many, or more, is hit.
SHARE = 20

SCHEMA = (
    "doc_id long, n_words long, n_hit long, item_ids array<string>, "
    "hit_words array<struct<start:int,end:int>>, spans array<struct<start:int,end:int>>"
)
_K = np.uint64(0xD6E8FEB86659FD93)


def combined(hashes: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on."""
    h = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            h = h * _K + hashes[at + j]
    return mix(h)


class WindowTable:
    """Shift table and suffix buckets for windows of one length."""

    def __init__(self, k: int, windows: dict[bytes, set[int]]):
        self.k, self.block = k, min(2, k)
        self.texts = list(windows)
        self.items = [sorted(windows[t]) for t in self.texts]
        words = Words(pa.array([t.decode() for t in self.texts]))
        first = words.first[:-1]
        self.shift = np.full(SHIFTS, k - self.block + 1, np.uint8)
        for end in range(self.block, k + 1):
            np.minimum.at(self.shift, combined(words.hashes, first + end - self.block, self.block) & np.uint64(SHIFTS - 1), k - end)
        # a bucket holds the windows of one suffix; within it they stand by the hash of all words
        suffix = combined(words.hashes, first + k - self.block, self.block)
        whole = combined(words.hashes, first, k)
        order = np.lexsort((whole, suffix))
        self.keys = (suffix ^ whole)[order]
        self.order = order[np.argsort(self.keys, kind="stable")]
        self.keys = np.sort(self.keys)

    def occurrences(self, words: Words) -> list[tuple[int, int]]:
        """(first word, window) for each place where a window stands."""
        k, step = self.k, self.k - self.block + 1
        ends = np.maximum(words.counts - k + 1, 0)  # places in each text
        stretches = -(-ends // step)
        text = np.repeat(np.arange(len(ends)), stretches)
        at = (np.arange(len(text)) - np.repeat(np.cumsum(stretches) - stretches, stretches)) * step
        last = words.first[:-1][text] + k - 1 + np.minimum(at + step, ends[text])
        at = words.first[:-1][text] + k - 1 + at  # a cursor is the last word of a place
        found = []
        while len(at):
            blocks = combined(words.hashes, at - self.block + 1, self.block)
            jump = self.shift[blocks & np.uint64(SHIFTS - 1)].astype(np.int64)
            here = np.flatnonzero(jump == 0)
            if len(here):
                start = at[here] - k + 1
                keys = combined(words.hashes, start, k) ^ blocks[here]
                lo, hi = np.searchsorted(self.keys, keys), np.searchsorted(self.keys, keys, side="right")
                for i in np.flatnonzero(lo < hi):
                    found += [(int(start[i]), int(w)) for w in self.order[lo[i] : hi[i]] if self.same(words, int(start[i]), int(w))]
            at = at + np.maximum(jump, 1)
            on = at < last
            at, last = at[on], last[on]
        return found

    def same(self, words: Words, start: int, window: int) -> bool:
        """Direct comparison of the words."""
        spans = zip(words.starts[start : start + self.k], words.ends[start : start + self.k])
        return b" ".join(words.data[a:b].tobytes() for a, b in spans) == self.texts[window]


def window_tables(items: list[tuple[str, str | None]], window: int) -> tuple[list[WindowTable], list[str]]:
    """Tables by window length, and the ids that their numbers mean."""
    names = sorted({i for i, _ in items})
    number = {n: k for k, n in enumerate(names)}
    by_length: dict[int, dict[bytes, set[int]]] = {}
    for name, text in items:
        words = Words(pa.array([text], pa.string()), hashes=False)
        own = [words.data[a:b].tobytes() for a, b in zip(words.starts, words.ends)]
        k = min(window, len(own))
        for i in range(len(own) - k + 1 if k else 0):
            by_length.setdefault(k, {}).setdefault(b" ".join(own[i : i + k]), set()).add(number[name])
    return [WindowTable(k, w) for k, w in sorted(by_length.items())], names


def _schema() -> pa.Schema:
    run = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), run, run)
    return pa.schema(list(zip(("doc_id", "n_words", "n_hit", "item_ids", "hit_words", "spans"), kinds)))


def search(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    tables, names = shared.value
    schema = _schema()
    for batch in batches:
        for part in text_chunks(batch):
            words = Words(part.column(1))
            n = len(words.counts)
            items, mark = [set() for _ in range(n)], np.zeros(len(words.starts) + 1, np.int64)
            for table in tables:
                for start, window in table.occurrences(words):
                    mark[start] += 1
                    mark[start + table.k] -= 1
                    items[words.text_of[start]].update(table.items[window])
            hit = np.cumsum(mark[:-1]) > 0
            begin, end = _word_runs(hit, words.first)
            of = words.text_of[begin] if len(begin) else begin
            points = code_points(words.data)
            hit_words, spans = [[] for _ in range(n)], [[] for _ in range(n)]
            for d, a, b in zip(of.tolist(), begin.tolist(), end.tolist()):
                zero, base = words.first[d], points[words.offsets[d]]
                hit_words[d].append({"start": a - zero, "end": b - zero})
                spans[d].append({"start": points[words.starts[a]] - base, "end": points[words.ends[b - 1]] - base})
            yield batch_of(
                schema,
                doc_id=part.column(0),
                n_words=words.counts,
                n_hit=np.bincount(words.text_of[hit], minlength=n),
                item_ids=[sorted(names[i] for i in x) for x in items],
                hit_words=hit_words,
                spans=spans,
            )


def _word_runs(hit: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of hit words inside one text."""
    edge = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cuts = first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(hit))]
    cuts = np.unique(cuts[hit[cuts] & hit[cuts - 1]])
    return np.sort(np.concatenate((begin, cuts))), np.sort(np.concatenate((end, cuts)))


def benchmark_blocks(benchmark: DataFrame, item_column: str, text_column: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of about block_bytes of text, dealt by hash of id and text."""
    items = benchmark.select(F.col(item_column).cast("string").alias("item_id"), F.col(text_column).alias("text"))
    items = items.where("item_id IS NOT NULL AND text IS NOT NULL")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = int(total // block_bytes) + 1
    for b in range(blocks):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    share: int = SHARE,
) -> DataFrame:
    """A row per document: words, hit words, items found, runs of hit words (in words and in code
    points), and whether a twentieth or more of the words is hit."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    blocks = list(_shared_blocks(spark, benchmark, item_column, item_text_column, window, block_bytes))
    if len(blocks) == 1:
        out = texts.mapInArrow(lambda it, b=blocks[0]: search(it, b), SCHEMA)
    else:
        out = united(texts, blocks)
    return out.withColumn("contaminated", F.expr(f"n_hit > 0 AND {share} * n_hit >= n_words"))


def _shared_blocks(spark, benchmark, item_column, text_column, window, block_bytes):
    for items in benchmark_blocks(benchmark, item_column, text_column, block_bytes):
        yield spark.sparkContext.broadcast(window_tables(items, window))


def united(texts: DataFrame, blocks: list) -> DataFrame:
    """The results of several passes, one row per document again."""
    rows = written(texts.withColumn("row", F.monotonically_increasing_id()), "decontamination")
    single = rows.select(F.col("row").alias("doc_id"), "text")
    parts = [single.mapInArrow(lambda it, b=b: search(it, b), SCHEMA).withColumnRenamed("doc_id", "row") for b in blocks]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    gather = lambda c: F.flatten(F.collect_list(c))
    merged = every.groupBy("row").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(gather("item_ids"))).alias("item_ids"),
        *[F.expr(MERGED.format(c=f"array_sort(flatten(collect_list({c})))")).alias(c) for c in ("hit_words", "spans")],
    )
    merged = merged.withColumn("n_hit", F.expr("aggregate(hit_words, 0L, (n, r) -> n + r.end - r.start)"))
    return rows.select("row", "doc_id").join(merged, "row").select("doc_id", "n_words", "n_hit", "item_ids", "hit_words", "spans")


#: Sorted runs joined where they overlap. Runs that touch stay as they are.
MERGED = (
    "aggregate({c}, cast(array() AS array<struct<start:int,end:int>>), (done, r) -> "
    "CASE WHEN size(done) > 0 AND r.start < element_at(done, -1).end "
    "THEN concat(slice(done, 1, size(done) - 1), array(named_struct('start', element_at(done, -1).start, "
    "'end', greatest(element_at(done, -1).end, r.end)))) ELSE concat(done, array(r)) END)"
)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", **how) -> DataFrame:
    """The documents, with all their columns, that are not contaminated."""
    row = fresh("_row", docs.columns)
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    found = contamination(rows, benchmark, id_column=row, text_column=text_column, **how)
    bad = found.where("contaminated").select(F.col("doc_id").alias(row))
    return rows.join(bad, row, "left_anti").drop(row)
