"""Importance resampling of documents towards a target distribution of hashed word n-grams.

Method: segment deduplication.  A newline is no part of a word, so it cuts a text into lines whose features can be counted
apart.  Equal lines of the corpus are counted first (pre-aggregated in every task), the features of each different line are
computed once and multiplied by its occurrences, and the bigrams that reach from one line into the next are added
separately, document by document.  A document's gains are put together the same way: the sum of each different line is
computed once and joined to the documents that hold it; what lies across lines is added.

Features are runs of 1 to 2 words, hashed into BUCKETS buckets by crc32.  A bucket's gain compares its share of the target
with its share of the corpus; a document's weight is the floored mean gain of its features; its score adds Gumbel noise from
a hash of its id, so that the highest scores are a draw without replacement in proportion to exp(weight / 1000).

Bounds.  Broadcast and gathered are the gains alone, BUCKETS numbers.  A line that a third of all documents hold is one row
after the first aggregation, and a plain join, which Spark splits, brings its sum back.  Ranks come from the number of rows
with each score (whole numbers within some tens of thousands, whatever the corpus) and an order within each score.

Defined results.  A null or empty text has no features and weight 0.  Equal rows (same doc_id and text) are separate documents
of one weight, with ranks that follow each other.  Rows without doc_id draw as if it were empty and come behind the others among equal scores;
among equal scores and ids the text's hash decides.  A single very long line is one segment.  Empty tables: an empty
corpus has no rows; an empty target gives every bucket the gain of no occurrence.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.chunks import ship
from shelfcast.llm.graph import stored
from shelfcast.llm.words import LOWER, separators, slices, split_words, text_bytes

BUCKETS = 10_000
SHARE = 25
"""Percent of the documents that are long enough."""
LEAST_WORDS = 20
SEED = 7
KEY_BYTES = 16

# Bytes between words are \x00-\x2F, \x3A-\x60 and \x7B-\x7F.
BETWEEN = separators(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
NEWLINE = 10
LONGEST = 64
"""Words up to so many bytes are hashed together, longer ones one by one."""
_U = np.uint32


def _byte_table() -> np.ndarray:
    """What crc32 does to its low byte, by its polynomial 0xEDB88320."""
    table = np.arange(256, dtype=_U)
    for _ in range(8):
        table = np.where(table & _U(1), (table >> _U(1)) ^ _U(0xEDB88320), table >> _U(1))
    return table


_STEP = _byte_table()


def _shift_tables() -> np.ndarray:
    """[length, place, byte]: a crc's byte at that place, moved on by ``length`` zero bytes (a linear map)."""
    tables = np.empty((LONGEST + 1, 4, 256), dtype=_U)
    for place in range(4):
        tables[0, place] = np.arange(256, dtype=_U) << _U(8 * place)
    for length in range(1, LONGEST + 1):
        before = tables[length - 1]
        tables[length] = _STEP[before & _U(255)] ^ (before >> _U(8))
    return tables


_SHIFT = _shift_tables().reshape(-1)


def _joined(left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """crc32 of two strings behind each other, from both crcs and the length of the second."""
    base, out = lengths.astype(np.int64) * 1024, right.copy()
    for place in range(4):
        out ^= _SHIFT[base + 256 * place + ((left >> _U(8 * place)) & _U(255)).astype(np.int64)]
    return out


class Features:
    """crc32 of words and of pairs of neighbours, for words given as byte ranges of lower-cased text."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.data, self.starts, self.ends = data, starts, ends
        self.lengths = ends - starts
        self.long = np.flatnonzero(self.lengths > LONGEST)
        self.words = self._of_words()
        # One more byte, the space that joins two words.
        raw = self.words ^ _U(0xFFFFFFFF)
        self.spaced = (_STEP[(raw ^ _U(32)) & _U(255)] ^ (raw >> _U(8))) ^ _U(0xFFFFFFFF)

    def _of_words(self) -> np.ndarray:
        short = np.minimum(self.lengths, LONGEST + 1)
        order = np.argsort(-short, kind="stable")
        starts, ordered = self.starts[order], short[order]
        crc = np.full(len(order), 0xFFFFFFFF, dtype=_U)
        for place in range(int(ordered[0]) if len(ordered) else 0):
            n = int(np.searchsorted(-ordered, -place, side="left"))
            crc[:n] = _STEP[(crc[:n] ^ self.data[starts[:n] + place]) & _U(255)] ^ (crc[:n] >> _U(8))
        out = np.empty_like(crc)
        out[order] = crc ^ _U(0xFFFFFFFF)
        for i in self.long.tolist():
            out[i] = zlib.crc32(self.data[self.starts[i]:self.ends[i]])
        return out

    def pairs(self, first: np.ndarray) -> np.ndarray:
        """crc32 of word ``first``, a space and the word behind it."""
        left, second = self.spaced[first], first + 1
        out = _joined(left, self.words[second], np.minimum(self.lengths[second], LONGEST))
        for at in np.flatnonzero(self.lengths[second] > LONGEST).tolist():
            i = second[at]
            out[at] = zlib.crc32(self.data[self.starts[i]:self.ends[i]], int(left[at]))
        return out


def _buckets(crc: np.ndarray) -> np.ndarray:
    return (crc % _U(BUCKETS)).astype(np.uint16)


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every line's features, and n_lines + 1 offsets."""
    words = split_words(LOWER[data], offsets, BETWEEN)
    found = Features(words.data, words.starts, words.ends)
    inner = np.ones(len(words.starts), dtype=bool)
    inner[words.first[1:][words.first[1:] > 0] - 1] = False  # the last word of a line has no neighbour in it
    pairs = np.flatnonzero(inner)
    owner = words.owner()
    every = np.concatenate((_buckets(found.words), _buckets(found.pairs(pairs))))
    owners = np.concatenate((owner, owner[pairs]))
    order = np.argsort(owners, kind="stable")
    return every[order], np.searchsorted(owners[order], np.arange(len(offsets)))


def crossings(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of each document's bigrams across line ends, their n_docs + 1 offsets, and words by document."""
    words = split_words(LOWER[data], offsets, BETWEEN)
    lines = np.concatenate(([0], np.cumsum(data == NEWLINE)))
    owner = words.owner()
    line = lines[words.starts]
    first = np.flatnonzero((owner[1:] == owner[:-1]) & (line[1:] != line[:-1]))
    # Only the words at line ends are hashed: each pair is two of them, side by side.
    ends = np.stack((first, first + 1), axis=1).ravel()
    found = Features(words.data, words.starts[ends], words.ends[ends])
    return _buckets(found.pairs(np.arange(0, len(ends), 2))), np.searchsorted(owner[first], np.arange(len(offsets))), words.counts


def _packed(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Runs of 16-bit values as one binary for each."""
    raw = np.ascontiguousarray(values.astype("<u2")).view(np.uint8)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer((2 * offsets).astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes())]).cast(pa.binary())


def _parts(batches):
    """Parts of Arrow batches whose texts have a bounded number of bytes together."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        data, offsets = text_bytes(table["text"])
        for low, high in slices(offsets):
            yield table.slice(low, high - low), data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]


def _line_rows(batches):
    for part, data, offsets in _parts(batches):
        values, cuts = line_features(data, offsets)
        raw = data.tobytes()
        keys = [hashlib.sha256(raw[a:b]).digest()[:KEY_BYTES] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        yield pa.record_batch([pa.array(keys, pa.binary()), part["occurrences"].combine_chunks().cast(pa.int64()),
                               _packed(values, cuts)], names=["line", "occurrences", "buckets"])


def _crossing_rows(batches):
    for part, data, offsets in _parts(batches):
        values, cuts, words = crossings(data, offsets)
        yield pa.record_batch([part["row"].combine_chunks().cast(pa.binary()), part["doc_id"].combine_chunks().cast(pa.int64()),
                               pa.array(words, pa.int64()), _packed(values, cuts)],
                              names=["row", "doc_id", "n_words", "buckets"])


def different_lines(texts: DataFrame) -> DataFrame:
    """(line key, occurrences, buckets) of every different line; its features are computed here and nowhere else."""
    ship(texts.sparkSession)
    lines = texts.select(F.explode(F.split("text", "\n")).alias("text")).filter("text <> ''")
    counted = lines.groupBy("text").agg(F.count(F.lit(1)).alias("occurrences"))
    return counted.mapInArrow(_line_rows, "line binary, occurrences long, buckets binary")


def across_lines(texts: DataFrame) -> DataFrame:
    """(row key, doc_id, n_words, buckets across lines) of every document."""
    ship(texts.sparkSession)
    return texts.select("row", "doc_id", "text").mapInArrow(
        _crossing_rows, "row binary, doc_id long, n_words long, buckets binary")


def _counting(batches):
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        table = pa.Table.from_batches([batch])
        data, offsets = text_bytes(table["buckets"])
        np.add.at(total, data.view("<u2"), np.repeat(np.array(table["occurrences"], dtype=np.int64), np.diff(offsets) // 2))
    at = np.flatnonzero(total)
    yield pa.record_batch([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["bucket", "n"])


def bucket_counts(lines: DataFrame, crossing: DataFrame) -> DataFrame:
    """(bucket, n): how often the features of all texts fall into each bucket; every task sends BUCKETS rows at most."""
    both = lines.select("occurrences", "buckets").union(crossing.select(F.lit(1).cast("long"), "buckets"))
    return both.mapInArrow(_counting, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of every bucket, from both tables of counts: BUCKETS rows each, whatever they count."""
    def counts(table: DataFrame) -> list[int]:
        found = dict(table.collect())
        return [found.get(bucket, 0) for bucket in range(BUCKETS)]

    s, t = counts(corpus), counts(target)
    all_s, all_t = float(sum(s) + BUCKETS), float(sum(t) + BUCKETS)
    return np.array([math.floor(1000 * math.log((b + 1) * all_s / ((a + 1) * all_t))) for a, b in zip(s, t)], dtype=np.int64)


def _summing(shared, keep: list[str]):
    def rows(batches):
        gain = shared.value
        for batch in batches:
            table = pa.Table.from_batches([batch])
            data, offsets = text_bytes(table["buckets"])
            sums = np.concatenate(([0], np.cumsum(gain[data.view("<u2")])))
            at = offsets // 2
            yield pa.record_batch([table[name].combine_chunks() for name in keep] + [pa.array(sums[at[1:]] - sums[at[:-1]], pa.int64())],
                                  names=[*keep, "gain"])
    return rows


def _text_rows(table: DataFrame) -> DataFrame:
    """doc_id, text without nulls, and a key of the row: equal rows have one key."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long") if "doc_id" in table.columns else F.lit(None).cast("long")
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), text)
    return table.select(doc_id.alias("doc_id"), text.alias("text"), _key(whole).alias("row"))


def _key(column: Column) -> Column:
    return F.unhex(F.substring(F.sha2(column, 256), 1, 2 * KEY_BYTES))


def _noise(seed: int) -> Column:
    """floor(-1000 ln(-ln u)) for a u that the id alone decides."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


def weighed(docs: DataFrame, target: DataFrame, seed: int = SEED) -> DataFrame:
    """row, doc_id, n_words, n_features, weight, score and ``copies``: one row for all equal rows of ``docs``."""
    spark = docs.sparkSession
    texts, wanted = _text_rows(docs), _text_rows(target)
    # The words at line ends are found anew for each of their two uses, which is quicker than to write them.
    lines, crossing = stored(different_lines(texts), "lines"), across_lines(texts)
    gain = gains(bucket_counts(lines, crossing), bucket_counts(different_lines(wanted), across_lines(wanted)))
    shared = spark.sparkContext.broadcast(gain)
    by_line = lines.select("line", "buckets").mapInArrow(_summing(shared, ["line"]), "line binary, gain long")
    held = texts.select("row", F.explode(F.split("text", "\n")).alias("line")).filter("line <> ''") \
        .select("row", _key(F.col("line")).alias("line"))
    own = crossing.mapInArrow(_summing(shared, ["row", "doc_id", "n_words"]), "row binary, doc_id long, n_words long, gain long")
    none = F.lit(None).cast("long")
    parts = held.join(by_line, "line").select("row", none.alias("doc_id"), none.alias("n_words"), "gain", F.lit(0).alias("copies")) \
        .union(own.select("row", "doc_id", "n_words", "gain", F.lit(1)))
    whole = parts.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.sum("gain").alias("gain"), F.sum("copies").alias("copies"))
    counted = whole.withColumn("n_features", F.greatest(2 * F.col("n_words") - 1, F.lit(0).cast("long")))
    # Lines of equal rows were added up once for each, so the mean is over all their features.
    counted = counted.withColumn("all", F.nullif(F.col("n_features") * F.col("copies"), F.lit(0).cast("long")))
    weight = F.coalesce(F.expr("(gain - pmod(gain, all)) div all"), F.lit(0).cast("long"))
    return counted.withColumn("weight", weight).select(
        "row", "doc_id", "n_words", "n_features", "weight", (F.col("weight") + _noise(seed)).alias("score"), "copies")


def resampled(docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS,
              seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; rank counts the drawn ones by score, others have none.

    Of the documents with at least ``least_words`` words, ``share`` percent are drawn, rounded down.
    """
    rows = stored(weighed(docs, target, seed), "weighed").withColumn("long", F.col("n_words") >= least_words)
    scores = rows.filter("long").groupBy("score").agg(F.sum("copies").alias("here"))
    up_to = Window.orderBy(F.col("score").desc())
    # One row for each different score, a whole number: their range does not grow with the corpus.
    places = scores.withColumn("before", F.sum("here").over(up_to.rowsBetween(Window.unboundedPreceding, -1)))
    drawn = int(rows.filter("long").agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]) * share // 100
    placed = rows.join(places.select("score", F.coalesce("before", F.lit(0)).alias("before")), "score", "left") \
        .withColumn("hopeful", F.coalesce(F.col("long") & (F.col("before") < drawn), F.lit(False)))
    among = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "row").rowsBetween(Window.unboundedPreceding, -1)
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = placed.filter("hopeful").withColumn("ahead", F.col("before") + F.coalesce(F.sum("copies").over(among), F.lit(0))) \
        .select(*columns, F.posexplode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("at", "one"), "ahead")
    rank = F.col("ahead") + F.col("at") + 1
    others = placed.filter("not hopeful").select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("one"))
    return ranked.select(*columns, F.when(rank <= drawn, rank).alias("rank")).union(
        others.select(*columns, F.lit(None).cast("long")))
