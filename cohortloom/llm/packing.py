"""Packing: hierarchical packing of whole documents into windows of several context sizes.

Method. A document is routed to the shortest tier (context size) that holds it; what is longer than
the longest tier first fills whole longest windows. Each tier is packed best-fit from long to short;
what a window leaves open is filled from the shorter tiers, and at last by cutting a document of a
shorter tier so that it fits exactly. The windows of a tier are dealt to step groups of equal token
budget so that the groups have nearly the same attention cost. Only the last window of a group of
GROUP_TOKENS ids can stay open; it is padded to the longest tier.

Each task packs the documents of its own partition in groups of bounded size, so nothing is
shuffled and no partition is held in memory. With `apart`, a group has the documents of one value of
a column (a language, say), so no window mixes two.

Edge cases: a null or empty text has the end id alone; null, repeated or clashing ids and extra
columns play no part; an empty table has no pieces.
"""
from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cohortloom.llm.common import batch_of, text_chunks
from cohortloom.llm.tokens import encoder

TIERS = (2048, 1024, 512, 256)
#: Ids that are packed together; bounds a task's memory and the share of open windows.
GROUP_TOKENS = 2_000_000
#: Ids of a step: the windows of one tier that are trained on together.
STEP_TOKENS = 32_768

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
    "offset long, tier int, step_group long"
)


class Pool:
    """Documents, or parts of them, that wait for a place: (length, document, start), by length."""

    def __init__(self, items: list[tuple[int, int, int]]):
        self.items = sorted(items)

    def __len__(self) -> int:
        return len(self.items)

    def best_fit(self, room: int) -> tuple[int, int, int] | None:
        """The longest that fits."""
        at = bisect.bisect_right(self.items, (room, float("inf"), 0))
        return self.items.pop(at - 1) if at else None

    def part(self, room: int) -> tuple[int, int, int]:
        """The first room ids of the shortest that is longer."""
        at = bisect.bisect_right(self.items, (room, float("inf"), 0))
        length, doc, start = self.items.pop(at)
        bisect.insort(self.items, (length - room, doc, start + room))
        return room, doc, start


def tier_of(length: int, tiers: tuple[int, ...]) -> int:
    return next(t for t in reversed(tiers) if t >= length)


def pack_lengths(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Windows as (tier, pieces); a piece is (length, document, start). Every id is in one piece."""
    longest, windows, rest = tiers[0], [], {t: [] for t in tiers}
    for doc, n in enumerate(lengths):
        for start in range(0, n - n % longest, longest):
            windows.append((longest, [(longest, doc, start)]))
        if n % longest:
            rest[tier_of(n % longest, tiers)].append((n % longest, doc, n - n % longest))
    for t in tiers:
        own = Pool(rest[t])
        shorter = Pool([x for u in tiers if u < t for x in rest[u]])
        while len(own) or t == tiers[-1] and len(shorter):
            room, pieces = t, []
            while room and (x := own.best_fit(room) or shorter.best_fit(room)):
                pieces.append(x)
                room -= x[0]
            if room and (len(shorter) or len(own)):
                pieces.append((shorter if len(shorter) else own).part(room))
                room = 0
            windows.append((t if not room else longest, pieces))
        left = {u: [] for u in tiers}
        for x in shorter.items:
            left[tier_of(x[0], tiers)].append(x)
        rest.update({u: left[u] for u in tiers if u < t})
    return windows


def step_groups(windows: list[tuple[int, list]], step_tokens: int) -> list[int]:
    """A group number for each window: groups hold one tier, and are dealt windows there and back
    in order of attention cost (the sum of squared piece lengths)."""
    out, base = [0] * len(windows), 0
    for t in sorted({t for t, _ in windows}, reverse=True):
        own = sorted((i for i, w in enumerate(windows) if w[0] == t), key=lambda i: (-sum(p[0] ** 2 for p in windows[i][1]), i))
        n = -(-len(own) * t // max(step_tokens, t))
        for k, i in enumerate(own):
            lap, at = divmod(k, n)
            out[i] = base + (at if lap % 2 == 0 else n - 1 - at)
        base += n
    return out


def packed(batches: Iterator[pa.RecordBatch], schema: pa.Schema, path: str, end_id: int, keeps_spaces: bool, tiers, group_tokens: int, step_tokens: int) -> Iterator[pa.RecordBatch]:
    encode, task = encoder(path, keeps_spaces), TaskContext.get().partitionId()
    held, window_base, step_base = 0, task << 40, task << 40
    # documents that wait, by the value that is kept apart: [ids held, doc ids, ids of each]
    waiting: dict[str | None, list] = {}

    def flush(of: str | None) -> pa.RecordBatch:
        nonlocal held, window_base, step_base
        n, docs, ids = waiting.pop(of)
        held -= n
        windows = pack_lengths([len(x) for x in ids], tiers)
        steps, rows = step_groups(windows, step_tokens), []
        for w, (t, pieces) in enumerate(windows):
            offset = 0
            for length, doc, start in pieces:
                rows.append((docs[doc], start, length, ids[doc][start : start + length].tobytes(), len(ids[doc]), window_base + w, offset, t, step_base + steps[w]))
                offset += length
        window_base, step_base = window_base + len(windows), step_base + max(steps) + 1
        return batch_of(schema, **dict(zip(schema.names, map(list, zip(*rows)))))

    for batch in batches:
        for part in text_chunks(batch):
            values = part.column(2).to_pylist() if part.num_columns > 2 else [None] * part.num_rows
            for doc, of, x in zip(part.column(0).to_pylist(), values, encode.encode(part.column(1).to_pylist())):
                own = waiting.setdefault(of, [0, [], []])
                own[0] += len(x) + 1
                own[1].append(doc)
                own[2].append(np.append(x, np.uint32(end_id)).astype("<u4"))
                held += len(x) + 1
                if held >= group_tokens:
                    yield flush(max(waiting, key=lambda v: waiting[v][0]))
    for of in list(waiting):
        yield flush(of)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    keeps_spaces: bool = True,
    tiers: tuple[int, ...] = TIERS,
    group_tokens: int = GROUP_TOKENS,
    step_tokens: int = STEP_TOKENS,
    apart: str | None = None,
) -> DataFrame:
    """Pieces of all documents with their ids (little-endian unsigned 32-bit) and places.

    tiers: context sizes, powers of two, falling. A window is as long as its tier and full, or it
    is padded to the longest. apart: a column whose values share no window.
    """
    more = [f"cast(`{apart}` AS string) AS apart"] if apart else []
    texts = docs.selectExpr(f"cast(`{id_column}` AS long) AS doc_id", f"`{text_column}` AS text", *more)
    schema = pa.schema([(n, t) for n, t in zip(("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "tier", "step_group"), (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))])
    return texts.mapInArrow(lambda it: packed(it, schema, tokenizer, end_id, keeps_spaces, tiers, group_tokens, step_tokens), SCHEMA)
