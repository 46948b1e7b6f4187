"""Benchmark decontamination: documents that hold a passage of a test item, also with some words replaced.

Method: spaced seeds.  Tokens are lower-cased runs of letters, digits and non-ASCII bytes.  Four fixed masks
look at 6 of at most 11 successive tokens and ignore the others; they are chosen so that every stretch that is accepted below,
wherever its replaced words are, has a seed of one of them (tests go through all placements).  Seeds of
the items and of the documents are joined on their hash; a bit filter of the item seeds, of bounded
size, keeps documents' seeds that cannot match from being sent.  Where the filter lets seeds through, the tokens
around them go on as one region.  Joined seeds name diagonals of region and item; all of a pair are checked in one row, and on one of
them the stretch of highest score (1 for an equal token, -2 for another) must have MATCHED equal tokens and a share of IDENTITY.

Short items have seeds and rules by their length.  One of 6 tokens and more may have one token replaced, anywhere: up to MATCHED its
seeds are all of its tokens but one, beyond them the masks hit.  One of 5 tokens is sought unchanged.  One of 1 to 4 tokens, which any text may hold by chance, is
found where it is all that a document says.

Skew: a passage that a third of all documents hold gives one region for each occurrence and no pairs of
documents; item tables carry no hint, Spark broadcasts them only if they are measured small.

Defined results.  An item without tokens, or null, matches nothing.  Null and empty texts are clean.  One row for each document row and item, with the best stretch;
equal rows are reported once.  Rows without doc_id, and items without item_id, are reported with a null in its place.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.chunks import ship, squeeze, unsqueeze
from shelfcast.llm.graph import stored
from shelfcast.llm.words import LOWER, mix, slices, split_words, text_bytes, window_starts

MASKS = ("11100100101", "11010111", "10100011011", "1110111")
SPAN = 11
SHORTEST = 5
"""Shorter items are sought as whole documents, this one unchanged, and longer ones with replaced tokens."""
MATCHED = 10
IDENTITY = 0.75
REACH = 64
"""Tokens kept on either side of a seed that passes the filter."""
BITS_EACH = 64
MOST_BITS = 1 << 28
PROBES = 3
BLOCKS = 16

_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[128:] = False
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
_FACTORS = mix(np.arange(1, SPAN + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _tokens(texts):
    data, offsets = text_bytes(texts)
    return split_words(LOWER[data], offsets, _BETWEEN)


def seeds(hashes: np.ndarray, first: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of one mask's windows; none crosses a document's end."""
    starts = window_starts(first, len(mask))
    total = np.full(len(starts), np.uint64(int(mask, 2)), dtype=np.uint64)
    for j, used in enumerate(mask):
        if used == "1":
            total += hashes[starts + j] * _FACTORS[j]
    return starts, mix(total)


def short_seeds(hashes: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and seeds of runs of n tokens, at most MATCHED: of the whole run up to SHORTEST, of all but one token beyond."""
    total = np.full(len(starts), np.uint64((1 << (SPAN + 1)) + n), dtype=np.uint64)
    for j in range(n):
        total += hashes[starts + j] * _FACTORS[j]
    if n <= SHORTEST:
        return starts, mix(total)
    holes = [mix(total - hashes[starts + j] * _FACTORS[j] + np.uint64(j << 20)) for j in range(n)]
    return np.tile(starts, n), np.concatenate(holes) if holes else np.zeros(0, dtype=np.uint64)


def _item_rows(batches):
    for batch in batches:
        words = _tokens(batch["text"])
        hashes = words.hashes()
        counts = words.counts
        at, seed, item = [], [], []
        for mask in MASKS:
            starts, h = seeds(hashes, words.first, mask)
            at.append(starts), seed.append(h), item.append(words.owner()[starts])
        for n in range(1, MATCHED + 1):
            own = np.flatnonzero(counts == n)
            starts, h = short_seeds(hashes, words.first[own], n)
            at.append(starts), seed.append(h), item.append(words.owner()[starts])
        at, seed, item = np.concatenate(at), np.concatenate(seed), np.concatenate(item)
        order = np.argsort(item, kind="stable")
        at, seed, item = at[order], seed[order], item[order]
        cut = np.searchsorted(item, np.arange(len(counts) + 1))
        for i in range(len(counts)):
            low, high = words.first[i], words.first[i + 1]
            yield pa.record_batch([
                batch["item_id"][i:i + 1], batch["item"][i:i + 1], pa.array([hashes[low:high].astype("<u8").tobytes()], pa.binary()),
                pa.array([seed[cut[i]:cut[i + 1]].view(np.int64)], pa.list_(pa.int64())),
                pa.array([(at[cut[i]:cut[i + 1]] - low).astype(np.int32)], pa.list_(pa.int32())),
                pa.array([int(counts[i])], pa.int32())], names=["item_id", "item", "tokens", "seeds", "places", "n"])


_ITEMS = "item_id long, item long, tokens binary, seeds array<long>, places array<int>, n int"


def _probes(hashes: np.ndarray, bits: int):
    for i in range(PROBES):
        yield (mix(hashes + np.uint64(i)) & np.uint64(bits - 1)).astype(np.int64)


def _fill(bits: int):
    def fill(batches):
        table = np.zeros(bits, dtype=bool)
        for batch in batches:
            values = np.array(batch["seed"], dtype=np.int64).view(np.uint64)
            for at in _probes(values, bits):
                table[at] = True
        if table.any():
            blocks = np.packbits(table, bitorder="little").reshape(BLOCKS, -1)
            yield pa.record_batch([pa.array(range(BLOCKS), pa.int32()),
                                   pa.array([squeeze(b) for b in blocks], pa.binary())], names=["block", "bits"])
    return fill


def _either(table: pa.Table) -> pa.Table:
    parts = [unsqueeze(b, np.uint8) for b in table["bits"].to_pylist()]
    return pa.table({"block": table["block"][:1].cast(pa.int32()),
                     "bits": pa.array([squeeze(np.bitwise_or.reduce(parts))], pa.binary())})


def seed_filter(items: DataFrame) -> tuple[np.ndarray, int]:
    """A bit table of all item seeds, at most MOST_BITS bits however many there are."""
    row = items.agg(F.sum(F.size("seeds"))).first()
    bits = min(MOST_BITS, 1 << max(12, (BITS_EACH * int(row[0] or 0)).bit_length()))
    found = items.select(F.explode("seeds").alias("seed")).mapInArrow(_fill(bits), "block int, bits binary") \
        .groupBy("block").applyInArrow(_either, "block int, bits binary").collect()
    table = np.zeros((BLOCKS, bits // 8 // BLOCKS), dtype=np.uint8)
    for block, packed in found:
        table[block] = unsqueeze(bytes(packed), np.uint8)
    return table.ravel(), bits


def _passing(hashes: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    left = np.arange(len(hashes))
    for i in range(PROBES):
        at = (mix(hashes[left] + np.uint64(i)) & np.uint64(bits - 1)).astype(np.int64)
        left = left[(table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
    return left


_REGIONS = "doc_id long, key long, begin long, tokens binary, seeds array<long>, places array<int>"


def _regions(filter_table, bits: int, lengths: tuple[int, ...]):
    def work(batches):
        table = filter_table.value
        for batch in batches:
            data, offsets = text_bytes(batch["text"])
            keys = batch["key"].to_pylist()
            for low, high in slices(offsets, 2 << 20):
                part = offsets[low:high + 1]
                words = split_words(LOWER[data[part[0]:part[-1]]], part - part[0], _BETWEEN)
                hashes = words.hashes()
                at, seed = [], []
                found = [seeds(hashes, words.first, mask) for mask in MASKS]
                for n in lengths:
                    whole = words.first[:-1][words.counts == n] if n < SHORTEST else window_starts(words.first, n)
                    found.append(short_seeds(hashes, whole, n))
                for starts, h in found:
                    hit = _passing(h, table, bits)
                    at.append(starts[hit]), seed.append(h[hit])
                at, seed = np.concatenate(at), np.concatenate(seed)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, seed = at[order], seed[order]
                owner = np.searchsorted(words.first, at, side="right") - 1
                new = np.concatenate(([True], (np.diff(at) > REACH) | (np.diff(owner) > 0)))
                cut = np.append(np.flatnonzero(new), len(at))
                rows = []
                for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
                    doc = int(owner[a])
                    begin = max(int(words.first[doc]), int(at[a]) - REACH)
                    end = min(int(words.first[doc + 1]), int(at[b - 1]) + SPAN + REACH)
                    rows.append((batch["doc_id"][low + doc].as_py(), keys[low + doc],
                                 begin - int(words.first[doc]), hashes[begin:end].astype("<u8").tobytes(),
                                 seed[a:b].view(np.int64), (at[a:b] - begin).astype(np.int32)))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()))
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      names=[c.split()[0] for c in _REGIONS.split(", ")])
    return work


def best_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """Begin, end and equal tokens of the stretch of highest score, 1 for equal and -2 for other tokens."""
    sums = np.concatenate(([0], np.cumsum(np.where(equal, 1, -2))))
    lows = np.minimum.accumulate(sums)
    end = int(np.argmax(sums - lows))
    begin = int(np.flatnonzero(sums[:end + 1] == lows[end])[-1])
    return begin, end, int(np.count_nonzero(equal[begin:end]))


_FOUND = "doc_id long, key long, item_id long, matched int, length int, first_token long"


def stretch(equal: np.ndarray, n: int) -> tuple[int, int, int] | None:
    """Begin, end and equal tokens of the stretch on a diagonal by which an item of n tokens counts as found."""
    whole = int(np.count_nonzero(equal)) if len(equal) == n else 0
    if n > MATCHED:
        a, b, matched = best_stretch(equal)
        if matched >= MATCHED and matched >= IDENTITY * (b - a):
            return a, b, matched
    return (0, n, whole) if whole >= n - (n > SHORTEST) else None


def _check(batches):
    for batch in batches:
        out = []
        for doc_id, key, begin, item_id, n, diagonals, mine, theirs in zip(*(
                batch[c].to_pylist() for c in ("doc_id", "key", "begin", "item_id", "n", "diagonals", "tokens", "item_tokens"))):
            x, y = np.frombuffer(mine, dtype="<u8"), np.frombuffer(theirs, dtype="<u8")
            best = None
            for diagonal in sorted(diagonals):
                low, high = max(0, diagonal), min(len(x), len(y) + diagonal)
                found = stretch(x[low:high] == y[low - diagonal:high - diagonal], n)
                if found:
                    a, b, matched = found
                    own = (matched, a - b, -(begin + low + a))
                    best = own if best is None or own > best else best
            if best:
                out.append((doc_id, key, item_id, best[0], -best[1], -best[2]))
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                  names=[c.split()[0] for c in _FOUND.split(", ")])


def row_digest(table: str = "docs"):
    """Tells rows apart that share a doc_id or have none."""
    return F.xxhash64(F.col(f"{table}.doc_id").cast("long"), F.col(f"{table}.text").cast("string"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, matched, length and first_token of every document's best stretch with each item,
    and the row's ``key`` (``row_digest``)."""
    spark = docs.sparkSession
    ship(spark)
    items = stored(benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                                    F.col("text").cast("string").alias("text"))
                   .distinct().withColumn("item", F.xxhash64("item_id", "text"))
                   .mapInArrow(_item_rows, _ITEMS), "items")
    table, bits = seed_filter(items)
    short = tuple(sorted(r[0] for r in items.filter(f"n >= 1 and n <= {MATCHED}").select("n").distinct().collect()))
    shared = spark.sparkContext.broadcast(table)
    regions = stored(docs.alias("docs").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                                 row_digest().alias("key"))
                     .mapInArrow(_regions(shared, bits, short), _REGIONS), "regions")
    regions = regions.dropDuplicates(["key", "begin", "tokens"])
    mine = regions.select("key", "begin", F.explode(F.arrays_zip("seeds", "places")).alias("s")) \
        .select("key", "begin", F.col("s.seeds").alias("seed"), F.col("s.places").alias("place"))
    theirs = items.select("item", F.explode(F.arrays_zip("seeds", "places")).alias("s")) \
        .select("item", F.col("s.seeds").alias("seed"), F.col("s.places").alias("item_place"))
    hits = mine.join(theirs, "seed").select(
        "key", "begin", "item", (F.col("place") - F.col("item_place")).alias("diagonal"))
    # A pair's diagonals are no more than the tokens of its region and its item.
    pairs = hits.groupBy("key", "begin", "item").agg(F.collect_set("diagonal").alias("diagonals"))
    whole = pairs.join(regions.select("doc_id", "key", "begin", "tokens"), ["key", "begin"]) \
        .join(items.select("item", "item_id", F.col("tokens").alias("item_tokens"), "n"), "item")
    return whole.mapInArrow(_check, _FOUND).groupBy("doc_id", "key", "item_id").agg(
        F.max(F.struct("matched", (-F.col("length")).alias("shorter"), (-F.col("first_token")).alias("sooner"))).alias("m")) \
        .select("doc_id", "key", "item_id", "m.matched", (-F.col("m.shorter")).alias("length"),
                (-F.col("m.sooner")).alias("first_token"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a passage of an item."""
    found = contaminated(docs, benchmark).select(F.col("doc_id").alias("leak_id"), F.col("key").alias("leak")).distinct()
    same = F.col("docs.doc_id").cast("long").eqNullSafe(F.col("found.leak_id")) & (row_digest() == F.col("found.leak"))
    return docs.alias("docs").join(found.alias("found"), same, "left_anti")
