"""Substring dedup: repeated lines and sentences are kept once, in the earliest document.

Method. The units of a text are its lines, and the sentences of lines that hold more than one. A
unit is normalised to its lower-cased words and known by a 128-bit digest. Sentences of fewer than
MIN_WORDS words are left alone, because short ones repeat by chance; in scripts written without
spaces two code points count as a word, and sentences end at their own full stops. The least length
of lines is the caller's: the query counts every line that has a word. Digests are grouped over all
documents; the occurrence in the document of the lowest rank (the id, then the hash of the text)
stays, and within a document the first one. All others are removed, with the white space behind them. Removed and kept stretches
are given as places in the original text.

Digests are counted with partial sums, so a unit that stands in a third of all documents is one row
per task; the join that marks its occurrences can be split by Spark.

Edge cases: a line without words (a rule of dashes) has an empty normal form and stays; a null or
empty text has no units and stays as it is; a null id ranks last; texts of one id, or without id, are
documents of their own; rows alike in id and text are one document and get the same result each; an empty table gives none.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import Words, batch_of, code_points, mix, powers, text_chunks

MIN_WORDS = 8
LAST = (1 << 63) - 1

UNITS = pa.schema(
    [("doc", pa.int64()), ("text_hash", pa.int64()), ("high", pa.int64()), ("low", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("again", pa.bool_())]
)
UNITS_SCHEMA = "doc long, text_hash long, high long, low long, start int, end int, again boolean"
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\r\n")] = True
#: Full stops that no space follows: ideographic, halfwidth, wide marks, danda.
_WIDE_STOPS = tuple(c.encode() for c in "。｡！？।")


def wide_stops(raw: np.ndarray) -> np.ndarray:
    """True for the three bytes of each wide full stop."""
    out = np.zeros(len(raw), bool)
    if len(raw) < 3:
        return out
    at = np.flatnonzero((raw[:-2] == 0xE3) | (raw[:-2] == 0xEF) | (raw[:-2] == 0xE0))
    for stop in _WIDE_STOPS:
        found = at[(raw[at] == stop[0]) & (raw[at + 1] == stop[1]) & (raw[at + 2] == stop[2])]
        for k in range(3):
            out[found + k] = True
    return out


def unspaced(raw: np.ndarray) -> np.ndarray:
    """True for the first byte of a letter of a script written without spaces: Thai, Lao, Myanmar,
    Khmer, kana and ideographs."""
    out = (raw >= 0xE3) & (raw <= 0xE9)
    out |= raw == 0xF0
    if len(raw) > 1:
        second = raw[1:]
        out[:-1] |= (raw[:-1] == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
        out[:-1] |= (raw[:-1] == 0xE1) & (((second >= 0x80) & (second <= 0x82)) | (second == 0x9E) | (second == 0x9F))
    return out


def unit_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of all lines, then of the sentences of lines with several; True for a line."""
    n = len(raw)
    texts = np.unique(offsets)
    lines = np.unique(np.concatenate((texts, np.flatnonzero(raw == 10) + 1)))
    stop = _STOP[raw]
    stop[:-1] &= _SPACE[raw[1:]]
    wide = wide_stops(raw)
    stop[2:] |= wide[2:] & ((raw[:-2] == 0xE3) | (raw[:-2] == 0xEF) | (raw[:-2] == 0xE0)) & wide[:-2]
    sentences = np.unique(np.concatenate((lines, np.flatnonzero(stop) + 1)))
    lines, sentences = lines[lines <= n], sentences[sentences <= n]
    line_of = np.searchsorted(lines, sentences[:-1], side="right") - 1
    several = np.bincount(line_of, minlength=len(lines))[line_of] > 1
    begin = np.concatenate((lines[:-1], sentences[:-1][several]))
    end = np.concatenate((lines[1:], sentences[1:][several]))
    return begin, end, np.arange(len(begin)) < len(lines) - 1


def sequence_hashes(hashes: np.ndarray, first: np.ndarray, last: np.ndarray, salt: int) -> np.ndarray:
    """Hash of the words first to last of each unit."""
    up, down = powers(len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(mix(hashes ^ np.uint64(salt)) * up[: len(hashes)], out=sums[1:])
        return mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))


def find_units(batches: Iterator[pa.RecordBatch], min_words: int, min_line_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_chunks(batch):
            words = Words(part.column(2), breaks=wide_stops)
            begin, end, is_line = unit_bounds(words.raw, words.offsets)
            first, last = np.searchsorted(words.starts, begin), np.searchsorted(words.starts, end)
            letters = np.concatenate(([0], np.cumsum(unspaced(words.raw) & ~wide_stops(words.raw))))
            size = 2 * (last - first) + letters[end] - letters[begin]
            long_enough = (last > first) & (size >= 2 * np.where(is_line, min_line_words, min_words))
            begin, end, first, last = (x[long_enough] for x in (begin, end, first, last))
            # a line's only sentence with words is the line itself
            keep = np.ones(len(first), bool)
            _, index = np.unique(np.column_stack((first, last)), axis=0, return_index=True)
            keep[:] = False
            keep[index] = True
            begin, end, first, last = (x[keep] for x in (begin, end, first, last))
            high, low = (sequence_hashes(words.hashes, first, last, s) for s in (0x5851F42D4C957F2D, 0x14057B7EF767814F))
            text = words.text_of[first] if len(first) else first
            order = np.lexsort((begin, low, high, text))
            again = np.zeros(len(first), bool)
            same = (text[order][1:] == text[order][:-1]) & (high[order][1:] == high[order][:-1]) & (low[order][1:] == low[order][:-1])
            again[order[1:]] = same
            points = code_points(words.raw)
            zero = points[words.offsets[:-1]][text]
            take = pa.array(text)
            yield batch_of(
                UNITS,
                doc=part.column(0).take(take),
                text_hash=part.column(1).take(take),
                high=high.view(np.int64),
                low=low.view(np.int64),
                start=points[begin] - zero,
                end=points[end] - zero,
                again=again,
            )


RESULT = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def cut(text: str | None, spans: list[tuple[int, int]]) -> tuple[str | None, list[tuple[int, int]], list[tuple[int, int]]]:
    """(text that stays, removed stretches, kept stretches); a sentence's leading space stays out."""
    if not spans:
        return text, [], [(0, len(text))] if text else []
    removed: list[list[int]] = []
    for a, b in sorted(spans):
        while b < len(text) and text[b] in " \t" and not text[b - 1 : b].isspace():
            b += 1
        while a < b and text[a] in " \t":
            a += 1
        if removed and a <= removed[-1][1]:
            removed[-1][1] = max(removed[-1][1], b)
        else:
            removed.append([a, b])
    edges = [0, *(x for r in removed for x in r), len(text)]
    kept = [(a, b) for a, b in zip(edges[::2], edges[1::2]) if a < b]
    return "".join(text[a:b] for a, b in kept), [tuple(r) for r in removed], kept


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS, min_line_words: int | None = None) -> DataFrame:
    """A row per document: doc_id, the text that stays, n_units (removed ones), removed_chars, and
    the removed and kept stretches in code points of the original. min_line_words is the least length
    of a line, that of a sentence if None; 1 takes every line that has a word."""
    line_words = min_words if min_line_words is None else min_line_words
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    keyed = texts.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("text_hash"), "text")
    units = keyed.mapInArrow(lambda it: find_units(it, min_words, line_words), UNITS_SCHEMA)
    # a unit that a document repeats counts there twice
    repeated = units.groupBy("high", "low").agg(F.count("*").alias("n"), F.min(F.struct("doc", "text_hash")).alias("keeper")).where("n > 1")
    surplus = units.join(repeated.select("high", "low", "keeper"), ["high", "low"]).where("again OR doc != keeper.doc OR text_hash != keeper.text_hash")
    marked = surplus.groupBy("doc", "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = keyed.join(marked, ["doc", "text_hash"], "left").select("doc", "text", "spans")
    out_schema = pa.schema(
        [("doc_id", pa.int64()), ("text", pa.string()), ("n_units", pa.int32()), ("removed_chars", pa.int64()), ("removed", pa.list_(RESULT)), ("kept", pa.list_(RESULT))]
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = lambda spans: [{"start": a, "end": b} for a, b in spans]
        for batch in batches:
            for part in text_chunks(batch):
                spans = [[(s["start"], s["end"]) for s in x or []] for x in part.column(2).to_pylist()]
                rows = [cut(t, s) for t, s in zip(part.column(1).to_pylist(), spans)]
                yield batch_of(
                    out_schema,
                    doc_id=[None if d == LAST else d for d in part.column(0).to_pylist()],
                    text=[r[0] for r in rows],
                    n_units=[len(s) for s in spans],
                    removed_chars=[sum(b - a for a, b in r[1]) for r in rows],
                    removed=[named(r[1]) for r in rows],
                    kept=[named(r[2]) for r in rows],
                )

    spans = "array<struct<start:int,end:int>>"
    return joined.mapInArrow(apply, f"doc_id long, text string, n_units int, removed_chars long, removed {spans}, kept {spans}")
