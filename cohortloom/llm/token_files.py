"""Token-ID output: Arrow stream files of equal-length sequences, with masks and a document table.

Format. A folder holds for each shard `tokens-NNNNNN.arrows` and `documents-NNNNNN.arrows`, both in
Arrow's stream format, and one `manifest.json`. The first holds record batches of ROWS rows with the
columns `ids` (fixed-size list of unsigned integers, 16 bits wide if the vocabulary allows it) and
`mask` (fixed-size list of booleans: false over the padding at a shard's end). Batches are not
compressed and have no nulls, so a memory-mapped file gives views of any sequence without a copy.
The second has a row per document: doc_id, start (ids before it in the shard), n_tokens.

Documents stand in ascending order of their id (nulls first, equal ids by text hash), in shards
that Spark's range partitioning cuts. A shard's file gets its name when it is complete, so a
repeated or lost task leaves nothing half-written.

Edge cases: a null or empty text is its end id alone; repeated ids are documents of their own; an
empty table gives a manifest without shards.
"""
from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.common import batch_of, text_chunks
from cohortloom.llm.tokens import encoder

SEQUENCE = 2048
#: Sequences in a record batch.
ROWS = 64

DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
SHARDS = pa.schema([("shard", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_sequences", pa.int64())])
READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
READ_SCHEMA = "doc_id long, start long, n_tokens long, ids binary"


def files(folder: str):
    """The file system of a folder (a path or a URI) and the path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def token_schema(sequence: int, kind: pa.DataType) -> pa.Schema:
    plain = lambda t: pa.list_(pa.field("item", t, nullable=False), sequence)
    return pa.schema([pa.field("ids", plain(kind), nullable=False), pa.field("mask", plain(pa.bool_()), nullable=False)])


class ShardWriter:
    """Cuts a stream of ids into sequences and writes them batch by batch."""

    def __init__(self, sink, sequence: int, kind: pa.DataType, rows: int):
        self.sequence, self.kind, self.rows = sequence, kind, rows
        self.writer = pa.ipc.new_stream(sink, token_schema(sequence, kind))
        self.open = np.zeros(sequence * rows, kind.to_pandas_dtype())
        self.filled = self.tokens = self.sequences = 0

    def add(self, ids: np.ndarray) -> None:
        self.tokens += len(ids)
        while len(ids):
            n = min(len(ids), len(self.open) - self.filled)
            self.open[self.filled : self.filled + n] = ids[:n]
            self.filled, ids = self.filled + n, ids[n:]
            if self.filled == len(self.open):
                self.flush()

    def flush(self) -> None:
        rows = -(-self.filled // self.sequence)
        if not rows:
            return
        n = rows * self.sequence
        ids, mask = self.open[:n].copy(), np.arange(n) < self.filled
        ids[self.filled :] = 0
        schema = token_schema(self.sequence, self.kind)
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((ids, mask), schema)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(arrays, schema=schema))
        self.sequences, self.filled = self.sequences + rows, 0

    def close(self) -> None:
        self.flush()
        self.writer.close()


def write_shard(batches: Iterator[pa.RecordBatch], folder: str, path: str, end_id: int, keeps_spaces: bool, sequence: int, rows: int) -> Iterator[pa.RecordBatch]:
    encode, task = encoder(path, keeps_spaces), TaskContext.get()
    shard, store, out = task.partitionId(), None, None
    n_docs = 0
    for batch in batches:
        for part in text_chunks(batch):
            if out is None:
                store, root = files(folder)
                kind = pa.uint16() if max(encode.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else pa.uint32()
                names = [f"{root}/{x}-{shard:06d}.arrows" for x in ("tokens", "documents")]
                part_names = [f"{x}.{task.taskAttemptId()}" for x in names]
                sinks = [store.open_output_stream(x) for x in part_names]
                out, table = ShardWriter(sinks[0], sequence, kind, rows), pa.ipc.new_stream(sinks[1], DOCUMENTS)
            found = encode.encode(part.column(1).to_pylist())
            sizes = np.array([len(x) + 1 for x in found], np.int64)
            starts = out.tokens + np.cumsum(sizes) - sizes
            out.add(np.concatenate([y for x in found for y in (x, [end_id])]).astype(out.open.dtype))
            table.write_batch(batch_of(DOCUMENTS, doc_id=part.column(0), start=starts, n_tokens=sizes))
            n_docs += len(found)
    if out is not None:
        out.close()
        table.close()
        for sink, part_name, name in zip(sinks, part_names, names):
            sink.close()
            store.move(part_name, name)
        yield batch_of(SHARDS, shard=[shard], n_docs=[n_docs], n_tokens=[out.tokens], n_sequences=[out.sequences])


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    keeps_spaces: bool = False,
    sequence: int = SEQUENCE,
    rows: int = ROWS,
) -> list[dict]:
    """Write all documents to the folder, which every executor must reach; returns the manifest,
    one entry per shard (a shard is a task, so this is bookkeeping of the job's own size)."""
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    tie = F.xxhash64("text")
    ordered = texts.repartitionByRange(F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
    store, root = files(folder)
    store.create_dir(root, recursive=True)
    shards = ordered.mapInArrow(
        lambda it: write_shard(it, folder, tokenizer, end_id, keeps_spaces, sequence, rows),
        "shard long, n_docs long, n_tokens long, n_sequences long",
    )
    manifest, base = [], 0
    for row in sorted(shards.collect(), key=lambda r: r.shard):
        manifest.append(row.asDict() | {"base": base})
        base += row.n_tokens
    with store.open_output_stream(f"{root}/manifest.json") as f:
        f.write(json.dumps({"sequence": sequence, "rows": rows, "end_id": end_id, "shards": manifest}).encode())
    return manifest


class TokenFile:
    """Random access to the sequences of a shard. A local file is memory-mapped."""

    def __init__(self, folder: str, shard: int):
        from pyarrow import fs

        store, root = files(folder)
        name = f"{root}/tokens-{shard:06d}.arrows"
        source = pa.memory_map(name) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(name)
        self.batches = list(pa.ipc.open_stream(source))
        self.sequence = self.batches[0].schema.field("ids").type.list_size
        self.rows = self.batches[0].num_rows

    def __len__(self) -> int:
        return (len(self.batches) - 1) * self.rows + self.batches[-1].num_rows

    def ids(self, k: int) -> np.ndarray:
        """Ids of sequence k: a view, not a copy."""
        batch, row = divmod(k, self.rows)
        return self.batch_ids(batch)[row * self.sequence : (row + 1) * self.sequence]

    def mask(self, k: int) -> np.ndarray:
        """Mask of sequence k, unpacked from its bits."""
        batch, row = divmod(k, self.rows)
        bits = self.batches[batch].column(1).flatten()
        return bits.slice(row * self.sequence, self.sequence).to_numpy(zero_copy_only=False)

    def batch_ids(self, batch: int) -> np.ndarray:
        return self.batches[batch].column(0).flatten().to_numpy(zero_copy_only=True)

    def stretch(self, start: int, n: int) -> np.ndarray:
        """n ids from a position of the shard on."""
        size, parts = self.rows * self.sequence, []
        while n:
            batch, at = divmod(start, size)
            x = self.batch_ids(batch)[at : at + n]
            parts.append(x)
            start, n = start + len(x), n - len(x)
        return np.concatenate(parts) if parts else np.zeros(0, np.uint16)


def read_shards(batches: Iterator[pa.RecordBatch], folder: str, limit: int) -> Iterator[pa.RecordBatch]:
    store, root = files(folder)
    for batch in batches:
        for shard, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            tokens = TokenFile(folder, shard)
            with store.open_input_file(f"{root}/documents-{shard:06d}.arrows") as f:
                for table in pa.ipc.open_stream(f):
                    starts, sizes = table.column(1).to_numpy(), table.column(2).to_numpy()
                    first = 0
                    while first < len(sizes):  # batches of at most limit ids, or one document
                        n = max(1, int(np.searchsorted(np.cumsum(sizes[first:]), limit, side="right")))
                        own = table.slice(first, n)
                        ids = [tokens.stretch(int(s), int(k)).astype("<u4").tobytes() for s, k in zip(starts[first : first + n], sizes[first : first + n])]
                        yield batch_of(READ, doc_id=own.column(0), start=starts[first : first + n] + base, n_tokens=own.column(2), ids=ids)
                        first += n


def read_token_files(spark: SparkSession, folder: str, limit: int = 1 << 20) -> DataFrame:
    """Documents of the files: doc_id, start (ids before it in all shards), n_tokens, ids as
    little-endian unsigned 32-bit integers."""
    store, root = files(folder)
    with store.open_input_stream(f"{root}/manifest.json") as f:
        shards = [(x["shard"], x["base"]) for x in json.loads(f.read())["shards"]]
    if not shards:
        return spark.createDataFrame([], READ_SCHEMA)
    listed = spark.sparkContext.parallelize(shards, len(shards)).toDF("shard long, base long")
    return listed.mapInArrow(lambda it: read_shards(it, folder, limit), READ_SCHEMA)
