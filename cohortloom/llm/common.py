"""Helpers shared by the corpus operators: batches of text, words, hashes, written tables."""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.session import send_package, shared_dir

#: Bytes of text that a Python task works on at once; a longer text is one piece of work by itself.
CHUNK_BYTES = 1 << 20

#: Bytes of a word: digits, letters and everything beyond ASCII.
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x41:0x5B] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
#: For bytes.translate: lower-cased word bytes, a space for every other byte.
TO_WORDS = bytes(int(LOWER[b]) if IS_WORD[b] else 0x20 for b in range(256))

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


#: Rows that Spark hands to a Python task at once; with whole texts, fewer than its default.
BATCH_ROWS = 2_000


def ship(spark) -> None:
    """Ready a session for the operators: smaller batches for tasks that hold whole texts (unless the
    session has a size of its own), and this package for workers whose path doesn't hold it."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, str(BATCH_ROWS))
    send_package(spark)


def remainder(id_column: str, k: int) -> Column:
    """crc32 of the id as text, modulo k; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % k


def fresh(name: str, columns: list[str]) -> str:
    """A column name that none of the columns has, whatever the case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def new_folder(spark, name: str) -> str:
    """Path of a folder not used before, in the folder that all executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read again: lineage ends here, and the table
    outlives lost executors. The files stay until the owner of the folder removes them."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_chunks(batch: pa.RecordBatch, limit: int = CHUNK_BYTES, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch with at most limit bytes of text, or a single longer text."""
    if not batch.num_rows:
        return
    text = batch.column(batch.schema.get_field_index(column))
    sizes = np.concatenate(([0], np.cumsum(byte_lengths(text))))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(sizes, sizes[start] + limit, side="right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def byte_lengths(text: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the n + 1 offsets of the texts; null is empty."""
    values = [v.as_buffer() if v.is_valid else b"" for v in text.cast(pa.large_binary())]
    sizes = [len(v) if isinstance(v, bytes) else v.size for v in values]
    return np.frombuffer(b"".join(values), dtype=np.uint8), np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def runs(flag: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of set positions; no run crosses an offset."""
    if not len(flag):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = flag.copy(), flag.copy()
    first[1:] &= ~flag[:-1]
    last[:-1] &= ~flag[1:]
    inner = offsets[:-1][offsets[:-1] < len(flag)]
    first[inner] = flag[inner]
    before = inner[inner > 0] - 1
    last[before] = flag[before]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2^64."""
    size = 1 << max(16, (n + 1).bit_length())
    if size not in _powers:
        up, down = np.full(size, _P), np.full(size, _P_INV)
        up[0] = down[0] = 1
        with np.errstate(over="ignore"):
            if len(_powers) > 2:
                _powers.clear()
            _powers[size] = np.cumprod(up), np.cumprod(down)
    return _powers[size]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(32))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """n + 1 running sums from which span_hashes() takes the hash of any span of the bytes."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums) - 1)
    with np.errstate(over="ignore"):
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words:
    """Lower-cased words of some texts, with their 64-bit hashes; all arrays in text order."""

    def __init__(self, text: pa.Array, hashes: bool = True, breaks=None):
        """breaks(bytes) marks further bytes that belong to no word."""
        raw, self.offsets = text_bytes(text)
        self.raw, self.data = raw, LOWER[raw]
        self.starts, self.ends = runs(IS_WORD[raw] & ~breaks(raw) if breaks else IS_WORD[raw], self.offsets)
        #: position of each text's first word, and one more
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)
        self.text_of = np.repeat(np.arange(len(self.counts)), self.counts)
        if hashes:
            self.sums = prefix_sums(self.data)
            self.hashes = span_hashes(self.sums, self.starts, self.ends)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of k words inside one text."""
        n = len(self.starts) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.text_of[:n] == self.text_of[k - 1 :])
        with np.errstate(over="ignore"):
            h = np.zeros(len(at), dtype=np.uint64)
            for j in range(k):
                h = h * _P + self.hashes[at + j]
        return at, mix(h)


def code_points(data: np.ndarray) -> np.ndarray:
    """n + 1 running counts of the code points that begin before each byte."""
    return np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_array(columns[f.name], f.type) for f in schema], schema=schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, type=kind)
