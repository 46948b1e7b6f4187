"""Documents dealt into chunks by a hash of their key, as compressed packs of rows.

A chunk is the unit of work of the operators that look at a text more than once: its documents are in one
place, replies about them are shuffled to the same place, and the texts cross the network once.  A chunk has
a bounded number of bytes, whatever hosts, sources or copies its documents belong to.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.words import mix, slices, text_bytes, trim

CHUNK_BYTES = 4 << 20
PARTITION_BYTES = 64 << 20
"""Texts that one task should hold at most, packed, and one bucket of hashes cover."""
PACK_SCHEMA = "chunk int, pack binary"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers anywhere import this package, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="shelfcast-")), "shelfcast_package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, files in os.walk(os.path.join(top, "shelfcast")):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, top))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


@dataclass(frozen=True)
class Extent:
    """How much there is, measured before anything is dealt out."""

    n_bytes: int
    n_rows: int
    parts: int

    @property
    def chunks(self) -> int:
        """Enough for every task, and none of more than about CHUNK_BYTES."""
        return max(2 * self.parts, -(-self.n_bytes // CHUNK_BYTES))

    @property
    def buckets(self) -> int:
        """Ranges of hashes that meet in one group: their number grows with the bytes, so that none outgrows a task."""
        return max(2 * self.parts, -(-self.n_bytes // PARTITION_BYTES))


def extent(docs: DataFrame) -> Extent:
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string"))), F.count(F.lit(1))).first()
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return Extent(int(size[0] or 0), int(size[1]), parts)


def chunk_of(keys: np.ndarray, n_chunks: int) -> np.ndarray:
    return (mix(np.asarray(keys).astype(np.int64).view(np.uint64) + np.uint64(77)) % np.uint64(n_chunks)).astype(np.int32)


def row_keys(ids: pa.Array, column) -> np.ndarray:
    """The 64-bit key of each row: its doc_id.  A row without one gets a key above 2**62 from its text."""
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    keys = np.array(ids.cast(pa.int64()).fill_null(0), dtype=np.int64)
    missing = np.flatnonzero(np.array(ids.is_null()))
    if len(missing):
        data, offsets = text_bytes(column)
        for i in missing:
            digest = hashlib.blake2b(data[offsets[i]:offsets[i + 1]], digest_size=8).digest()
            keys[i] = (1 << 62) + (int.from_bytes(digest, "little") >> 2)
    return keys


def as_packs(batches, n_chunks: int) -> Iterator[pa.RecordBatch]:
    """Each Arrow batch of documents as one compressed pack for each chunk that it has rows of."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for low, high in slices(text_bytes(table["text"])[1], 64 << 20):
            part = table.slice(low, high - low)
            chunk = chunk_of(row_keys(part["doc_id"], part["text"]), n_chunks)
            order = np.argsort(chunk, kind="stable")
            cuts = np.flatnonzero(np.diff(chunk[order])) + 1
            groups = np.split(order, cuts)
            packs = [pack(part.take(pa.array(group))) for group in groups]
            yield pa.record_batch([pa.array(chunk[[g[0] for g in groups]], pa.int32()),
                                   pa.array(packs, pa.binary())], names=["chunk", "pack"])


def pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema.remove_metadata()) as out:
        out.write_table(table.replace_schema_metadata(None).combine_chunks())
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue())


def unpack(packs) -> pa.Table | None:
    """The rows of some packs, by key and then text, or None if there is no pack."""
    trim()
    tables = [pa.ipc.open_stream(zstandard.decompress(p)).read_all() for p in packs]
    if not tables:
        return None
    table = pa.concat_tables(tables).combine_chunks()
    keys = row_keys(table["doc_id"], table["text"])
    order = np.argsort(keys, kind="stable")
    same = np.flatnonzero(np.diff(keys[order]) == 0)
    if len(same):
        texts = table["text"]
        order = np.array(sorted(range(len(keys)), key=lambda i: (keys[i], texts[i].as_py() or "")))
    return table.take(pa.array(order))


def into_chunks(docs: DataFrame, n_chunks: int) -> DataFrame:
    """Packs of documents, each chunk's in one partition.  ``docs`` has doc_id, text and what else is wanted."""
    ship(docs.sparkSession)
    packs = docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")}) \
        .mapInArrow(lambda batches: as_packs(batches, n_chunks), PACK_SCHEMA)
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_chunks * CHUNK_BYTES // PARTITION_BYTES)
    return packs.repartition(parts, "chunk")


def squeeze(values: np.ndarray) -> bytes:
    """A whole-number array as bytes, alike bytes side by side so that they compress."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueeze(blob: bytes, kind=np.uint64) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def squeeze_sorted(values: np.ndarray) -> bytes:
    return squeeze(np.diff(values, prepend=values.dtype.type(0)))


def unsqueeze_sorted(blob: bytes, kind=np.uint64) -> np.ndarray:
    return np.cumsum(unsqueeze(blob, kind), dtype=kind)


def cuts(sorted_values: np.ndarray, n: int) -> np.ndarray:
    """n + 1 positions that cut sorted 64-bit values into n equal ranges of values."""
    edges = np.array([(i << 64) // n for i in range(1, n)], dtype=np.uint64)
    return np.concatenate(([0], np.searchsorted(sorted_values, edges), [len(sorted_values)]))
