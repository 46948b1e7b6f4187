"""Token ids in files of range-coded sections, in ascending doc_id order, and back.

Texts are encoded with the tokenizers library.  A text is cut before a space that stands before a printable sign, around a
single line end, and between a letter and a stop, where the byte-level splitting rule cuts in any case; each different segment is encoded
once for each worker.

Within a section ids are coded as their rank by frequency there, and these frequencies are the coder's order 0.

Files: documents are range-partitioned and sorted by doc_id, and each task writes sections of whole documents, up to
SECTION_IDS ids or one longer document.  A section is self-contained: magic, block length, number of documents and of ids, the
table of documents, the ids by rank with their shares, what mostly follows, the lengths of the blocks, and the blocks, each coded and checked on its own (``range_coder``).  Spark writes
the sections as rows (part, number, n_tokens, section) of Parquet files, so a failed task leaves nothing behind and any store
that Spark reaches will do.  Where a document's ids start follows from the sums by part and by section; only those are in
a window, never ids or documents.

Defined results.  Null text counts as empty and has the end id only.  Rows without doc_id come first; rows with one doc_id follow each
other in no fixed order.  Repeated rows are separate documents.  Other columns are ignored.  Empty table: no files, no rows.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm import range_coder
from shelfcast.llm.chunks import extent, ship, squeeze, unsqueeze
from shelfcast.llm.segments import SegmentCache
from shelfcast.llm.words import slices, text_bytes
from shelfcast.session import shared_path

MAGIC = b"TIDS\x02"
SECTION_IDS = 1 << 24
PART_BYTES = 32 << 20
SLICE_BYTES = 4 << 20
KEPT_SEGMENTS = 1 << 20
_HEAD = struct.Struct("<5sIIQII")
SECTIONS = "part int, number int, n_tokens long, section binary"
_DOCS = "part int, number int, place long, doc_id long, start long, n_tokens long, ids_crc32 long"

# Bytes that may follow a space at which a text is cut: no white space begins with one of them.
_AFTER = np.zeros(256, dtype=bool)
_AFTER[0x21:0x7F] = True
_AFTER[0xC3:0xF5] = True
_AFTER[[0xE1, 0xE2, 0xE3]] = False
_PRINTED = np.zeros(256, dtype=bool)
_PRINTED[0x21:0x7F] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
# Second bytes of the letters that begin with 0xC3: all but the signs of multiplication and division.
_LETTER_C3 = np.zeros(256, dtype=bool)
_LETTER_C3[0x80:0xC0] = True
_LETTER_C3[[0x97, 0xB7]] = False
STOPS = b".,;:!?"
JOINED_BYTES = 2048
"""New segments are put together to texts of about so many bytes, since a call for each costs as much as its ids."""


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.cache = SegmentCache(self._encode_segments, KEPT_SEGMENTS)
        # A byte-level token has one sign for each byte that it stands for; an added token stands for its content.
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        lengths = {i: len(token) for token, i in vocabulary.items()}
        lengths |= {i: len(t.content.encode("utf-8")) for i, t in self.library.get_added_tokens_decoder().items()}
        added = "".join(t.content for t in self.library.get_added_tokens_decoder().values()).encode("utf-8")
        self.stops = np.zeros(256, dtype=bool)
        self.stops[[c for c in STOPS if c not in added]] = True
        self.lengths = np.zeros(max(lengths, default=0) + 1, dtype=np.int64)
        self.lengths[list(lengths)] = list(lengths.values())

    def _encode_segments(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments and how many each has; a segment that opens with a cut in any text follows another in one call."""
        raw = b"".join(segments)
        data = np.frombuffer(raw, dtype=np.uint8)
        ends = np.cumsum(np.fromiter(map(len, segments), dtype=np.int64, count=len(segments)))
        begins = np.concatenate(([0], ends[:-1]))
        second = np.minimum(begins + 1, ends - 1)
        follows = (data[begins] == 32) & _AFTER[data[second]]
        follows[1:] &= np.diff(begins // JOINED_BYTES) == 0
        follows[0] = False
        opens = np.append(begins[~follows], len(raw)).tolist()
        flat = self._encode_texts([raw[a:b] for a, b in zip(opens[:-1], opens[1:])])[0]
        reach = np.cumsum(self.lengths[flat])
        last = np.minimum(np.searchsorted(reach, ends), len(reach) - 1)
        if not len(flat) or (reach[last] != ends).any() or last[-1] != len(flat) - 1:
            return self._encode_texts(segments)
        return flat, np.diff(last, prepend=-1)

    def _encode_texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = self.library.encode_batch_fast([t.decode("utf-8") for t in texts], add_special_tokens=False)
        ids = [np.array(f.ids, dtype=np.int32) for f in found]
        return np.concatenate(ids), np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id, and n + 1 offsets."""
        n = len(offsets) - 1
        full = np.flatnonzero(np.diff(offsets))
        opens = np.zeros(len(data), dtype=bool)
        if len(data) > 2:
            opens[:-1] |= (data[:-1] == 32) & _AFTER[data[1:]]
            lone = (data[1:-1] == 10) & _PRINTED[data[:-2]] & _PRINTED[data[2:]]
            opens[1:-1] |= lone
            opens[2:] |= lone
            letter = _LETTER[data[1:-1]] | (data[:-2] == 0xC3) & _LETTER_C3[data[1:-1]]
            opens[2:] |= letter & self.stops[data[2:]]
            opens[1] |= _LETTER[data[0]] & self.stops[data[1]]
        opens[offsets[full]] = True
        # A cut needs both its neighbours in one text.
        last = offsets[full + 1] - 1
        inner = last[~np.isin(last, offsets[full])]
        opens[inner[data[inner] == 32]] = False
        starts = np.flatnonzero(opens)
        body, sums = self.cache.ids_of(data, starts)
        sizes = np.zeros(n, dtype=np.int64)
        sizes[full] = np.diff(np.append(sums[np.searchsorted(starts, offsets[full])], sums[-1]))
        ends = np.concatenate(([0], np.cumsum(sizes + 1)))
        out = np.full(ends[-1], end_id, dtype=np.int32)
        inside = np.ones(len(out), dtype=bool)
        inside[ends[1:] - 1] = False
        out[inside] = body
        return out, ends


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_section(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    if len(ids) and (ids.min() < 0 or ids.max() > 0xFFFF):
        raise ValueError("an id has more than 16 bits")
    times = np.bincount(ids)
    used = np.argsort(-times, kind="stable")[:np.count_nonzero(times)]
    rank = np.zeros(len(times), dtype=np.uint16)
    rank[used] = np.arange(len(used))
    share = range_coder.shares(times[used])
    block = range_coder.block_length(len(ids))
    ranks = rank[ids]
    first = range_coder.followers(ranks)
    blocks = range_coder.encode(ranks, block, share, first)
    present = np.packbits([i is not None for i in doc_ids], bitorder="little").tobytes()
    table = b"".join(struct.pack("<I", len(x)) + x for x in (
        present, squeeze(used.astype(np.uint16)), squeeze(share.astype(np.int32)), squeeze(first),
        squeeze(np.array([i or 0 for i in doc_ids], dtype=np.int64)), squeeze(counts.astype(np.int64)),
        squeeze(np.array([len(b) for b in blocks], dtype=np.int64))))
    head = _HEAD.pack(MAGIC, block, len(doc_ids), len(ids), len(table), zlib.crc32(table))
    return head + table + b"".join(blocks)


def read_section(section: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, ids of each document, and all ids; raises ValueError for a damaged section."""
    magic, block, n_docs, n_ids, size, check = _HEAD.unpack_from(section)
    table = section[_HEAD.size:_HEAD.size + size]
    if magic != MAGIC or zlib.crc32(table) != check:
        raise ValueError("not a section, or a damaged one")
    parts, at = [], 0
    for _ in range(7):
        length, = struct.unpack_from("<I", table, at)
        parts.append(table[at + 4:at + 4 + length])
        at += 4 + length
    present = np.unpackbits(np.frombuffer(parts[0], dtype=np.uint8), count=n_docs, bitorder="little")
    used, share = unsqueeze(parts[1], np.uint16).astype(np.uint32), unsqueeze(parts[2], np.int32)
    first = unsqueeze(parts[3], np.uint16)
    numbers, counts, lengths = (unsqueeze(p, np.int64) for p in parts[4:])
    ends = _HEAD.size + size + np.concatenate(([0], np.cumsum(lengths)))
    blocks = [section[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    ids = used[range_coder.decode(blocks, n_ids, block, share, first)]
    return [i if p else None for i, p in zip(numbers.tolist(), present.tolist())], counts, ids


def _write(path: str, end_id: int):
    def work(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        own = encoder(path)
        doc_ids, counts, runs, held = [], [], [], 0

        def section() -> pa.RecordBatch:
            blob = write_section(doc_ids, np.concatenate(counts), np.concatenate(runs))
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([number], pa.int32()),
                                    pa.array([held], pa.int64()), pa.array([blob], pa.binary())],
                                   names=["part", "number", "n_tokens", "section"])
        for batch in batches:
            data, offsets = text_bytes(batch["text"])
            ids_of_batch = batch["doc_id"].to_pylist()
            for low, high in slices(offsets, SLICE_BYTES):
                span = offsets[low:high + 1]
                ids, ends = own.encode(data[span[0]:span[-1]], span - span[0], end_id)
                if held and held + len(ids) > SECTION_IDS:
                    yield section()
                    doc_ids, counts, runs, held, number = [], [], [], 0, number + 1
                doc_ids += ids_of_batch[low:high]
                counts.append(np.diff(ends))
                runs.append(ids)
                held += len(ids)
        if doc_ids:
            yield section()
    return work


def write_token_files(docs: DataFrame, out: str, path: str | None = None, end_id: int = 2) -> None:
    """Encode every text and write the sections below ``out``, in ascending doc_id order."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = extent(docs)
    parts = max(size.parts, -(-size.n_bytes // PART_BYTES))
    # The text's hash orders rows of one id, or of none, so that a hot one is spread over partitions.
    docs.withColumn("mark", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "mark").sortWithinPartitions("doc_id", "mark") \
        .mapInArrow(_write(path, end_id), SECTIONS).write.parquet(out)


def _read(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, number, before, blob in zip(*(batch[c].to_pylist() for c in ("part", "number", "before", "section"))):
            doc_ids, counts, ids = read_section(blob)
            raw, ends = ids.astype("<u4", copy=False).tobytes(), np.cumsum(counts)
            n = len(doc_ids)
            crcs = [zlib.crc32(raw[4 * (end - count):4 * end]) for end, count in zip(ends.tolist(), counts.tolist())]
            yield pa.record_batch([
                pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, number, np.int32)), pa.array(np.arange(n)),
                pa.array(doc_ids, pa.int64()), pa.array(before + ends - counts), pa.array(counts), pa.array(crcs, pa.int64())],
                names=[c.split()[0] for c in _DOCS.split(", ")])


def read_token_files(spark: SparkSession, out: str) -> DataFrame:
    """Every document of the files: part, number, place in the section, doc_id, start, n_tokens, ids_crc32."""
    ship(spark)
    sections = spark.read.schema(SECTIONS).parquet(out)
    sums = sections.groupBy("part").agg(F.sum("n_tokens").alias("sum"))
    # One row for each file.
    parts = sums.select("part", (F.sum("sum").over(Window.orderBy("part")) - F.col("sum")).alias("earlier"))
    inside = sections.select("part", "number", "n_tokens").withColumn(
        "inside", F.sum("n_tokens").over(Window.partitionBy("part").orderBy("number")) - F.col("n_tokens"))
    before = inside.join(parts, "part").select("part", "number", (F.col("earlier") + F.col("inside")).alias("before"))
    return sections.join(before, ["part", "number"]).mapInArrow(_read, _DOCS)


def round_trip(docs: DataFrame, path: str | None = None, end_id: int = 2) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from files written for it."""
    spark = docs.sparkSession
    out = shared_path(spark, "tokens")
    write_token_files(docs, out, path, end_id)
    return read_token_files(spark, out).select("doc_id", "start", "n_tokens", "ids_crc32")
