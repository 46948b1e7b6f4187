"""Substring dedup: words of every repeated window of ``width`` words go, save where the window comes first.

Method: Rabin-Karp hashes of every window, counted across the corpus in two exact steps.  First each chunk
sends the distinct short fingerprints of its windows (a few bits more than the number of windows needs) to
the part of the fingerprint range they fall in, and gets back one bit for each: found in another chunk or
not.  Only windows that may be repeated then go on with 128 bits of hash and the order of their document,
and the part answers which are not the first.  Neighbouring windows merge into maximal intervals.

Skew: a chunk sends a window once however often it holds it, so a window that a third of all documents share
reaches its part at most once for each chunk.  Texts are shuffled once.

Defined results.  Null or empty text: no words, nothing removed.  Rows with one doc_id count as consecutive
parts of one document, in the order of their texts; no window crosses rows.  Rows without doc_id come after
all others, in the order of a digest of their text.  Fewer than ``width`` words: kept whole.
An empty table gives an empty table.  Other columns are carried along, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shelfcast.llm.chunks import (
    Extent, cuts, extent, into_chunks, row_keys, squeeze, squeeze_sorted, unpack, unsqueeze, unsqueeze_sorted)
from shelfcast.llm.words import split_words, text_bytes, window_hashes, window_starts

WIDTH = 20
SPARE_BITS = 10
"""A fingerprint has this many bits beyond log2 of the number of windows: about one false reply in 1000."""

_BITS = "bucket int, chunk int, blob binary"


def _windows(packs, width: int):
    table = unpack(packs)
    words = split_words(*text_bytes(table["text"]))
    starts = window_starts(words.first, width)
    return table, words, starts, window_hashes(words.hashes(), starts, width)


def _fingerprints(hashes: np.ndarray, shift: int) -> np.ndarray:
    return (hashes >> np.uint64(shift)) << np.uint64(shift)


def _send_fingerprints(width: int, shift: int, buckets: int):
    def send(table: pa.Table) -> pa.Table:
        hashes = _windows(table["pack"].to_pylist(), width)[3]
        values = np.unique(_fingerprints(hashes, shift))
        at = cuts(values, buckets)
        full = np.flatnonzero(np.diff(at))
        return pa.table({
            "bucket": pa.array(full, pa.int32()),
            "chunk": pa.array([table["chunk"][0].as_py()] * len(full), pa.int32()),
            "blob": pa.array([squeeze_sorted(values[at[i]:at[i + 1]] >> np.uint64(shift)) for i in full],
                             pa.binary())})
    return send


def _answer_fingerprints(table: pa.Table) -> pa.Table:
    lists = [unsqueeze_sorted(blob) for blob in table["blob"].to_pylist()]
    merged = np.concatenate(lists)
    merged.sort()
    shared = np.unique(merged[1:][merged[1:] == merged[:-1]])
    blobs = [np.packbits(np.isin(values, shared, assume_unique=True)).tobytes() for values in lists]
    return pa.table({"bucket": table["bucket"].cast(pa.int32()), "chunk": table["chunk"].cast(pa.int32()),
                     "blob": pa.array(blobs, pa.binary())})


def _suspects(packs: pa.Table, answers: pa.Table, width: int, shift: int, buckets: int):
    """Windows whose fingerprint is found twice, here or in another chunk."""
    table, words, starts, hashes = _windows(packs["pack"].to_pylist(), width)
    values, counts = np.unique(_fingerprints(hashes, shift), return_counts=True)
    twice = counts > 1
    at = cuts(values, buckets)
    for bucket, blob in zip(answers["bucket"].to_pylist(), answers["blob"].to_pylist()):
        low, high = at[bucket], at[bucket + 1]
        twice[low:high] |= np.unpackbits(np.frombuffer(blob, dtype=np.uint8), count=high - low).astype(bool)
    chosen = twice[np.searchsorted(values, _fingerprints(hashes, shift))]
    return table, words, starts[chosen], hashes[chosen]


def _send_suspects(width: int, shift: int, buckets: int):
    def send(packs: pa.Table, answers: pa.Table) -> pa.Table:
        if not packs.num_rows:
            return pa.table({"bucket": pa.array([], pa.int32()), "chunk": pa.array([], pa.int32()),
                             "blob": pa.array([], pa.binary())})
        table, words, starts, hashes = _suspects(packs, answers, width, shift, buckets)
        second = window_hashes(words.hashes(1), starts, width, 1)
        keys = row_keys(table["doc_id"], table["text"])[words.owner()[starts]]
        order = np.lexsort((starts, second, hashes))
        h, g, k, s = hashes[order], second[order], keys[order], starts[order]
        again = np.zeros(len(h), dtype=bool)
        again[1:] = (h[1:] == h[:-1]) & (g[1:] == g[:-1])
        here = np.sort(s[again])
        h, g, k, s = (x[~again] for x in (h, g, k, s))
        at = cuts(h, buckets)
        blobs = []
        for i in range(buckets):
            low, high = at[i], at[i + 1]
            if high > low or (i == 0 and len(here)):
                own = here if i == 0 else here[:0]
                parts = (squeeze_sorted(h[low:high]), squeeze(g[low:high]), squeeze(k[low:high]),
                         squeeze(s[low:high]), squeeze_sorted(own.astype(np.uint64)))
                blobs.append((i, pa.array(parts, pa.binary())))
        return pa.table({
            "bucket": pa.array([i for i, _ in blobs], pa.int32()),
            "chunk": pa.array([packs["chunk"][0].as_py()] * len(blobs), pa.int32()),
            "blob": pa.array([_joined(parts.to_pylist()) for _, parts in blobs], pa.binary())})
    return send


def _joined(parts: list[bytes]) -> bytes:
    return np.array([len(p) for p in parts], dtype=np.int64).tobytes() + b"".join(parts)


def _parted(blob: bytes) -> list[bytes]:
    ends = 40 + np.cumsum(np.frombuffer(blob[:40], dtype=np.int64))
    return [blob[low:high] for low, high in zip([40, *ends[:-1]], ends)]


def _answer_suspects(table: pa.Table) -> pa.Table:
    parts = [_parted(blob) for blob in table["blob"].to_pylist()]
    h = [unsqueeze_sorted(p[0]) for p in parts]
    source = np.repeat(np.arange(len(parts)), [len(x) for x in h])
    h = np.concatenate(h)
    g = np.concatenate([unsqueeze(p[1]) for p in parts])
    k = np.concatenate([unsqueeze(p[2], np.int64) for p in parts])
    s = np.concatenate([unsqueeze(p[3], np.int64) for p in parts])
    order = np.lexsort((k, g, h))
    h, g = h[order], g[order]
    later = np.zeros(len(h), dtype=bool)
    later[1:] = (h[1:] == h[:-1]) & (g[1:] == g[:-1])
    source, s = source[order][later], s[order][later]
    blobs = []
    for i, p in enumerate(parts):
        here = np.concatenate((s[source == i].astype(np.uint64), unsqueeze_sorted(p[4])))
        blobs.append(squeeze_sorted(np.sort(here)))
    return pa.table({"bucket": table["bucket"].cast(pa.int32()), "chunk": table["chunk"].cast(pa.int32()),
                     "blob": pa.array(blobs, pa.binary())})


def kept_bytes(words, covered: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Kept words joined by one space, document after document, and n_docs + 1 offsets."""
    lengths = np.where(covered, 0, words.ends - words.starts + 1)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    out = np.full(total, 32, dtype=np.uint8)
    keep = np.flatnonzero(~covered)
    if len(keep):
        inside = np.zeros(len(words.data) + 1, dtype=np.int8)
        np.add.at(inside, words.starts[keep], 1)
        np.add.at(inside, words.ends[keep], -1)
        picked = words.data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
        target = np.ones(total, dtype=bool)
        target[ends[keep] - 1] = False
        out[target] = picked
    offsets = np.concatenate(([0], ends))[words.first]
    return out.tobytes(), offsets


def _remove(width: int, schema: pa.Schema):
    def remove(packs: pa.Table, answers: pa.Table) -> pa.Table:
        if not packs.num_rows:
            return schema.empty_table()
        table = unpack(packs["pack"].to_pylist())
        words = split_words(*text_bytes(table["text"]))
        edges = np.zeros(len(words.starts) + 1, dtype=np.int64)
        for blob in answers["blob"].to_pylist():
            starts = unsqueeze_sorted(blob).astype(np.int64)
            np.add.at(edges, starts, 1)
            np.add.at(edges, starts + width, -1)
        covered = np.cumsum(edges[:-1]) > 0
        out, offsets = kept_bytes(words, covered)
        texts = [out[low:max(low, high - 1)] for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        gone = np.concatenate(([0], np.cumsum(covered)))[words.first]
        columns = {name: table[name] for name in table.column_names}
        result = {"kept_text": pa.array(texts, pa.binary()).cast(pa.string()),
                  "n_words": pa.array(words.counts, pa.int64()), "n_removed": pa.array(np.diff(gone), pa.int64()),
                  "rows": pa.StructArray.from_arrays([c.combine_chunks() for c in columns.values()],
                                                     names=list(columns))}
        return pa.table(result).cast(schema)
    return remove


def remove_repeats(docs: DataFrame, width: int = WIDTH, size: Extent | None = None) -> DataFrame:
    """One row per input row: ``rows`` (the input columns), ``kept_text``, ``n_words``, ``n_removed``."""
    size = size or extent(docs)
    buckets = size.buckets
    shift = max(0, 64 - (max(1, size.n_bytes).bit_length() + SPARE_BITS))
    chunks = into_chunks(docs, size.chunks)
    inner = docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")}).schema
    result = StructType().add("kept_text", "string").add("n_words", "long").add("n_removed", "long") \
        .add("rows", inner)
    arrow = to_arrow_schema(result)

    first = chunks.groupBy("chunk").applyInArrow(_send_fingerprints(width, shift, buckets), _BITS)
    answers = first.groupBy("bucket").applyInArrow(_answer_fingerprints, _BITS)
    second = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _send_suspects(width, shift, buckets), _BITS)
    removed = second.groupBy("bucket").applyInArrow(_answer_suspects, _BITS)
    return chunks.groupBy("chunk").cogroup(removed.groupBy("chunk")).applyInArrow(_remove(width, arrow), result)


def digests(kept: DataFrame) -> DataFrame:
    return kept.select(F.col("rows.doc_id").alias("doc_id"), "n_words", "n_removed",
                       F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def shortened(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with the repeated windows cut out of ``text``; a text that loses nothing stays byte for byte."""
    kept = remove_repeats(docs, width)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("rows.text"))
    return kept.select(*[text.alias(c) if c == "text" else F.col(f"rows.`{c}`").alias(c) for c in docs.columns])
