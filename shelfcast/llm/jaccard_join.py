"""N-gram Jaccard join: documents whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more.

Method: adaptive multi-match prefixes.  Shingles are ordered by how many documents hold them, rarest first
(counted in a sketch of fixed size; any order that all documents share is right).  A document of n shingles
must share at least a = ceil(0.8 n) of them with a partner, so with its first n - a + l shingles it shares at
least l, and with a partner that chose another l at least the smaller of both.  Each document takes the l
whose estimated cost is least: the postings that its prefix meets, plus the verification of the partners
that can share l of them, at most postings / l.  Before verification both sizes are known, and with them the overlap that
the pair needs; what lies behind the prefixes can add no more than the longer rest, so the prefixes must share the
difference.

Postings are exchanged three times.  First only the prefix shingles, to learn which of them a second document has in
its prefix; the others are left out from then on, and a document knows how many of its prefix shingles can be shared at
all.  If those are fewer than a partner of any size in the list would need, it leaves the list.  Entries of
long lists carry a bit map of the document's shared prefix shingles: a bit that only one document of a pair has is a shingle
that the other lacks, so the maps bound what both share, and a pair that cannot share enough is not put out, however many
long lists it is in.

Groups of copies.  Documents with equal sets are one class, and only its smallest member goes on.  Candidates
come in two rounds.  In the first, each document meets one document of every posting list and size class, the one with
the fewest shingles of its own, and of those the one that it shares most with is verified: one pair for each document,
whatever the size of the group.  In the second, posting lists yield only pairs that are not yet in one component, all
of them, and those that share enough prefix shingles are verified.  So no link between different components is
missed, and a group of n near copies needs about n pairs.

Hot lists.  A chunk sends a prefix shingle once, with its number of documents, so the first exchange has no hot list.  A list of
HOT_LIST entries and more is dealt over as many groups as there are buckets, by chunk.  In the first round each group finds leaders
of its own, and these meet the list's smallest leader.  Before the second round the documents of hot lists are counted by
component: a list of one component is not sent at all; of another, the largest component's documents stay dealt out
and only the others go to every group.

Verification compares whole sets, with
the first text of a pair sent once to each chunk that holds partners of it.

Defined results.  Null or empty text, or no words: an empty set, linked with nothing.  Fewer than five words:
the whole sequence is the one shingle.  Rows with one doc_id are one document: each row has its own set,
links of any hold for all.  Rows without doc_id take part under a key made from their text and get the
component's smallest doc_id, or null if it has none.  Other columns are ignored.  Empty table: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from shelfcast.llm.chunks import (
    Extent, cuts, extent, into_chunks, row_keys, squeeze, squeeze_sorted, unpack, unsqueeze, unsqueeze_sorted)
from shelfcast.llm.graph import components, stored
from shelfcast.llm.words import LOWER, mix, shingle_sets, split_words, text_bytes

WIDTH = 5
PERCENT = 80
NO_ID = 1 << 62
SKETCH_BITS = 20
SKETCH_BLOCKS = 16
MOST_MATCHES = 4
"""The longest prefix asks for so many shared shingles."""
VERIFY_COST = 20
"""Cost of one verification, in postings read."""
PAIRS_AT_ONCE = 1 << 20
LONG_LIST = 32
MAP_WORDS = 8
"""64-bit words of a document's bit map of shared prefix shingles."""
HOT_LIST = 1 << 16
"""Entries from which a posting list is dealt over many groups."""
NOBODY = -(1 << 63)

_ROWS = "kind int, chunk int, key long, same long, doc_id long, n int, d1 long, d2 long, blob binary"
_LISTS = "bucket int, chunk int, blob binary"
_PAIRS = "a long, ca int, b long, cb int, shared int, need int"
_LEADERS = _PAIRS + ", token long, size int, own long"
_TEXTS = "chunk int, a long, text string, bs array<long>"


def least_shared(n: np.ndarray) -> np.ndarray:
    return (PERCENT * n + 99) // 100


def needed_in_prefixes(n, matches, other_n, other_matches) -> np.ndarray:
    """Shingles that the prefixes of a similar pair share at least.

    A similar pair shares 80 / 180 of both sizes.  Behind the prefix that ends first in the common order lie
    least_shared - l shingles of its document, and no other shared ones.
    """
    n, other_n = n.astype(np.int64), other_n.astype(np.int64)
    overlap = -(-PERCENT * (n + other_n) // (100 + PERCENT))
    rest = np.maximum(least_shared(n) - matches, least_shared(other_n) - other_matches)
    return np.maximum(np.minimum(matches, other_matches), overlap - rest)


def _node_keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A key for each row, and the key of the first row with its doc_id.

    Rows are sorted by key and text; equal rows share a key, another text under one doc_id gets its own.
    """
    same = row_keys(table["doc_id"], table["text"])
    keys = same.copy()
    repeated = np.flatnonzero(np.diff(same) == 0) + 1
    if len(repeated):
        texts = table["text"]
        own = row_keys(pa.nulls(len(keys), pa.int64()), texts)
        for i in repeated.tolist():
            keys[i] = keys[i - 1] if texts[i].as_py() == texts[i - 1].as_py() else own[i]
    return keys, same


def _sets(texts) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(texts)
    return shingle_sets(split_words(LOWER[data], offsets), WIDTH)


def _digests(values: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """128 bits for each set that do not depend on order: two sums of differently mixed hashes."""
    sums = [np.concatenate(([np.uint64(0)], np.cumsum(mix(values * np.uint64(m) + np.uint64(1))))) for m in (1, 3)]
    return [(s[ends[1:]] - s[ends[:-1]]).view(np.int64) for s in sums]


def _slots(values: np.ndarray) -> np.ndarray:
    return (mix(values) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _describe(batches):
    """Set size and digest of every row, and the task's counts of shingles by sketch slot."""
    counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
    for batch in batches:
        for chunk, packed in zip(batch["chunk"].to_pylist(), batch["pack"].to_pylist()):
            table = unpack([packed])
            values, ends = _sets(table["text"])
            counts += np.bincount(_slots(values), minlength=len(counts)).astype(np.uint32)
            n, digests = len(table), _digests(values, ends)
            keys = row_keys(table["doc_id"], table["text"])
            yield pa.record_batch([
                pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, chunk, np.int32)), pa.array(keys),
                pa.array(keys), table["doc_id"].combine_chunks(), pa.array(np.diff(ends).astype(np.int32)),
                pa.array(digests[0]), pa.array(digests[1]), pa.nulls(n, pa.binary())],
                names=[c.split()[0] for c in _ROWS.split(", ")])
    if counts.any():
        blocks = counts.reshape(SKETCH_BLOCKS, -1)
        none = pa.nulls(SKETCH_BLOCKS, pa.int64())
        yield pa.record_batch([
            pa.array(np.ones(SKETCH_BLOCKS, np.int32)), pa.array(np.arange(SKETCH_BLOCKS, dtype=np.int32)),
            none, none, none, pa.nulls(SKETCH_BLOCKS, pa.int32()), none, none,
            pa.array([squeeze(block) for block in blocks], pa.binary())],
            names=[c.split()[0] for c in _ROWS.split(", ")])


def _add_counts(table: pa.Table) -> pa.Table:
    total = sum(unsqueeze(blob, np.uint32).astype(np.uint64) for blob in table["blob"].to_pylist())
    return pa.table({"block": table["chunk"].cast(pa.int32())[:1], "blob": [squeeze(total)]})


def frequency_sketch(described: DataFrame) -> np.ndarray:
    """Documents by slot: 2**SKETCH_BITS numbers, whatever the size of the corpus; the noise floor is 0."""
    blocks = described.filter("kind = 1").groupBy("chunk").applyInArrow(_add_counts, "block int, blob binary")
    counts = np.zeros((SKETCH_BLOCKS, (1 << SKETCH_BITS) // SKETCH_BLOCKS), dtype=np.uint64)
    for block, blob in blocks.collect():
        counts[block] = unsqueeze(bytes(blob))
    counts = counts.ravel()
    usual = np.uint64(np.median(counts))
    floor = usual + np.uint64(4 * np.sqrt(float(usual)))
    return np.minimum(np.where(counts > floor, counts - usual, 0), (1 << 20) - 1).astype(np.uint32)


def prefixes(values: np.ndarray, ends: np.ndarray, frequency: np.ndarray):
    """For each document its l, and the entries (shingle, document number) of its prefix."""
    n = np.diff(ends)
    owner = np.repeat(np.arange(len(n)), n)
    seen = frequency[_slots(values)].astype(np.int64)
    order = np.argsort((owner << 20) | seen, kind="stable")
    values, seen = values[order], seen[order]
    sums = np.concatenate(([0], np.cumsum(seen)))
    most = np.minimum(MOST_MATCHES, least_shared(n))
    best, cost = np.ones(len(n), dtype=np.int64), np.full(len(n), np.inf)
    for matches in range(1, MOST_MATCHES + 1):
        length = np.minimum(n - least_shared(n) + matches, n)
        postings = sums[ends[:-1] + length] - sums[ends[:-1]]
        now = np.where(matches <= most, postings * (1 + VERIFY_COST / matches), np.inf)
        better = now < cost
        best, cost = np.where(better, matches, best), np.where(better, now, cost)
    length = np.where(n > 0, n - least_shared(n) + best, 0)
    inside = np.arange(len(values)) - ends[:-1][owner] < length[owner]
    return best, values[inside], owner[inside]


def _prefix_entries(packs: pa.Table, nodes: pa.Table, frequency, shift: int):
    """Entries of a chunk's nodes by token: token, key, label, n and l."""
    table = unpack(packs["pack"].to_pylist())
    keys, _ = _node_keys(table)
    want, labels = nodes["key"].to_numpy(), nodes["label"].to_numpy()
    order = np.argsort(want)
    want, labels = want[order], labels[order]
    rows = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])) & np.isin(keys, want))
    values, ends = _sets(table["text"].take(pa.array(rows)))
    matches, tokens, owner = prefixes(values, ends, frequency.value)
    label = labels[np.searchsorted(want, keys[rows])]
    tokens = (tokens >> np.uint64(shift)) << np.uint64(shift)
    order = np.argsort(tokens, kind="stable")
    return tokens[order], owner[order], keys[rows], label, np.diff(ends).astype(np.int32), matches


def _send_tokens(frequency, buckets: int, shift: int):
    """The prefix shingles alone, each with how many documents of the chunk have it."""
    def send(packs: pa.Table, nodes: pa.Table) -> pa.Table:
        if not packs.num_rows or not nodes.num_rows:
            return _no_lists()
        tokens, counts = np.unique(_prefix_entries(packs, nodes, frequency, shift)[0], return_counts=True)
        at = cuts(tokens, buckets)
        return _lists(packs, [(i, _joined(squeeze_sorted(tokens[at[i]:at[i + 1]] >> np.uint64(shift)),
                                          squeeze(counts[at[i]:at[i + 1]].astype(np.uint32))))
                              for i in np.flatnonzero(np.diff(at)).tolist()])
    return send


def _joined(*parts: bytes) -> bytes:
    return np.array([len(p) for p in parts], dtype=np.int64).tobytes() + b"".join(parts)


def _parted(blob: bytes, n: int) -> list[bytes]:
    ends = 8 * n + np.cumsum(np.frombuffer(blob[:8 * n], dtype=np.int64))
    return [blob[low:high] for low, high in zip([8 * n, *ends[:-1].tolist()], ends.tolist())]


def _no_lists() -> pa.Table:
    return pa.table({"bucket": pa.array([], pa.int32()), "chunk": pa.array([], pa.int32()),
                     "blob": pa.array([], pa.binary())})


def _lists(packs: pa.Table, blobs: list) -> pa.Table:
    return pa.table({"bucket": pa.array([i for i, _ in blobs], pa.int32()),
                     "chunk": pa.array([packs["chunk"][0].as_py()] * len(blobs), pa.int32()),
                     "blob": pa.array([blob for _, blob in blobs], pa.binary())})


def _shared_tokens(most: int):
    """Three bits for each sent shingle: does another entry have it, is its list long, is it hot (of ``most`` entries)?"""
    def shared(table: pa.Table) -> pa.Table:
        parts = [_parted(blob, 2) for blob in table["blob"].to_pylist()]
        lists, counts = [unsqueeze_sorted(p[0]) for p in parts], [unsqueeze(p[1], np.uint32) for p in parts]
        values, place = np.unique(np.concatenate(lists), return_inverse=True)
        size = np.bincount(place, np.concatenate(counts))[place]
        blobs, hot, low = [], [], 0
        for tokens in lists:
            own, low = size[low:low + len(tokens)], low + len(tokens)
            blobs.append(np.packbits(np.concatenate((own > 1, own >= LONG_LIST, own >= most))).tobytes())
            hot.append(bool((own >= most).any()))
        return pa.table({"bucket": table["bucket"].cast(pa.int32()), "chunk": table["chunk"].cast(pa.int32()),
                         "blob": pa.array(blobs, pa.binary()), "hot": pa.array(hot, pa.bool_())})
    return shared


class _Known:
    """What a chunk knows of its prefix shingles, each once: which are shared, long and hot, and whose hot ones are."""

    def __init__(self, tokens: np.ndarray, inputs: pa.Table, buckets: int):
        self.tokens, self.counts = np.unique(tokens, return_counts=True)
        at = cuts(self.tokens, buckets)
        self.shared, self.long, self.hot = (np.zeros(len(self.tokens), dtype=bool) for _ in range(3))
        for bucket, blob in _answers(inputs, 1):
            low, high = at[bucket], at[bucket + 1]
            bits = np.unpackbits(np.frombuffer(blob, dtype=np.uint8), count=3 * (high - low)).reshape(3, -1)
            self.shared[low:high], self.long[low:high], self.hot[low:high] = bits
        self.majority = np.full(len(self.tokens), NOBODY, dtype=np.int64)
        mine = np.flatnonzero(self.hot)
        at = cuts(self.tokens[mine], buckets)
        for bucket, blob in _answers(inputs, 2):
            self.majority[mine[at[bucket]:at[bucket + 1]]] = unsqueeze(blob, np.int64)

    def spread(self, values: np.ndarray) -> np.ndarray:
        """A value of each shingle for every entry of it."""
        return np.repeat(values, self.counts)


def _answers(inputs: pa.Table, kind: int):
    mine = inputs.filter(pc.equal(inputs["kind"], kind))
    return zip(mine["bucket"].to_pylist(), mine["blob"].to_pylist())


def _send_labels(frequency, buckets: int, shift: int):
    """Of the hot shingles alone: the components that hold each in this chunk, and how many documents of them."""
    def send(packs: pa.Table, inputs: pa.Table) -> pa.Table:
        nodes = inputs.filter(pc.equal(inputs["kind"], 0))
        if not packs.num_rows or not nodes.num_rows or not any(True for _ in _answers(inputs, 1)):
            return _no_lists()
        tokens, owner, _, label, _, _ = _prefix_entries(packs, nodes, frequency, shift)
        known = _Known(tokens, inputs, buckets)
        hot = known.spread(known.hot)
        pairs = np.stack((tokens[hot].view(np.int64), label[owner[hot]]), axis=1)
        pairs, counts = np.unique(pairs, axis=0, return_counts=True) if len(pairs) else (pairs, np.zeros(0, dtype=np.int64))
        token = pairs[:, 0].copy().view(np.uint64)
        order = np.argsort(token, kind="stable")
        token, holder, counts = token[order], pairs[order, 1], counts[order]
        at = cuts(token, buckets)
        return _lists(packs, [(i, _joined(squeeze(token[at[i]:at[i + 1]]), squeeze(holder[at[i]:at[i + 1]]), squeeze(counts[at[i]:at[i + 1]])))
                              for i in np.flatnonzero(np.diff(at)).tolist()])
    return send


def _majorities(table: pa.Table) -> pa.Table:
    """For each chunk's hot shingles the component with most documents, or NOBODY where there is no other."""
    parts = [_parted(blob, 3) for blob in table["blob"].to_pylist()]
    tokens = [unsqueeze(p[0]) for p in parts]
    token, holder, counts = np.concatenate(tokens), np.concatenate([unsqueeze(p[1], np.int64) for p in parts]), np.concatenate(
        [unsqueeze(p[2], np.int64) for p in parts])
    order = np.lexsort((holder, token))
    t, h, c = token[order], holder[order], counts[order]
    opens = np.flatnonzero(np.concatenate(([True], (t[1:] != t[:-1]) | (h[1:] != h[:-1]))))
    t, h, c = t[opens], h[opens], np.add.reduceat(c, opens)
    order = np.lexsort((h, -c, t))
    t, h = t[order], h[order]
    first = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
    alone = np.diff(np.append(first, len(t))) == 1
    most = np.where(alone, NOBODY, h[first])
    blobs = [squeeze(most[np.searchsorted(t[first], np.unique(own))]) for own in tokens]
    return pa.table({"bucket": table["bucket"].cast(pa.int32()), "chunk": table["chunk"].cast(pa.int32()),
                     "blob": pa.array(blobs, pa.binary())})


def _send_lists(frequency, buckets: int, shift: int, second_round: bool):
    """The entries that another document shares, with what candidate pairs are judged by."""
    def send(packs: pa.Table, inputs: pa.Table) -> pa.Table:
        nodes = inputs.filter(pc.equal(inputs["kind"], 0))
        if not packs.num_rows or not nodes.num_rows:
            return _no_lists()
        tokens, owner, keys, label, n, matches = _prefix_entries(packs, nodes, frequency, shift)
        known = _Known(tokens, inputs, buckets)
        shared, long, hot, majority = (known.spread(x) for x in (known.shared, known.long, known.hot, known.majority))
        common = np.bincount(owner[shared], minlength=len(n)).astype(np.int32)
        maps = np.zeros((len(n), MAP_WORDS), dtype=np.uint64)
        place = mix(tokens[shared]) % np.uint64(64 * MAP_WORDS)
        np.bitwise_or.at(maps, (owner[shared], (place >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (place & np.uint64(63)))
        # Documents of different components never share a shingle that one component holds alone.
        sent = shared & ~(hot & (majority == NOBODY)) if second_round else shared
        everywhere = second_round & hot & (label[owner] != majority)
        salt = packs["chunk"][0].as_py() % buckets

        def blobs_of(chosen: np.ndarray, to: list[int], copied: bool) -> list:
            some = np.flatnonzero(chosen)
            token, own, far = tokens[some], owner[some], long[some]
            at, out = cuts(token, buckets), []
            for i in np.flatnonzero(np.diff(at)).tolist():
                mine, long_ones = own[at[i]:at[i + 1]], far[at[i]:at[i + 1]]
                blob = _joined(squeeze_sorted(token[at[i]:at[i + 1]] >> np.uint64(shift)), squeeze(keys[mine]), squeeze(label[mine]),
                               squeeze(n[mine]), squeeze(matches[mine].astype(np.int32)), squeeze(common[mine]),
                               squeeze(long_ones.astype(np.uint8)), squeeze(maps[mine[long_ones]].ravel()),
                               squeeze(np.full(len(mine), copied, dtype=np.uint8)))
                out += [(base + i, blob) for base in to]
            return out

        return _lists(packs, [*blobs_of(sent & ~hot, [0], False),
                              *blobs_of(sent & hot & ~everywhere, [buckets * (1 + salt)], False),
                              *blobs_of(sent & hot & everywhere, [buckets * (1 + other) for other in range(buckets)], True)])
    return send


def _read_lists(table: pa.Table) -> dict[str, np.ndarray]:
    """Entries of a bucket by token (``rank``), of those documents that may have a partner in the token's list."""
    parts = []
    for chunk, blob in zip(table["chunk"].to_pylist(), table["blob"].to_pylist()):
        raw = _parted(blob, 9)
        token, long = unsqueeze_sorted(raw[0]), unsqueeze(raw[6], np.uint8).astype(bool)
        maps = np.zeros((len(token), MAP_WORDS), dtype=np.uint64)
        maps[long] = unsqueeze(raw[7]).reshape(-1, MAP_WORDS)
        parts.append((token, unsqueeze(raw[1], np.int64), unsqueeze(raw[2], np.int64),
                      *(unsqueeze(r, np.int32).astype(np.int64) for r in raw[3:6]), long, maps,
                      np.full(len(token), chunk, dtype=np.int32), unsqueeze(raw[8], np.uint8).astype(bool)))
    columns = dict(zip(("rank", "key", "label", "n", "matches", "common", "long", "map", "chunk", "copied"),
                       (np.concatenate(c) for c in zip(*parts))))
    order = np.argsort(columns["rank"], kind="stable")
    columns = {name: column[order] for name, column in columns.items()}
    token = columns["rank"]
    columns["token"] = token.view(np.int64)
    columns["rank"] = np.cumsum(np.concatenate(([0], token[1:] != token[:-1])))
    return _hopeful(columns)


def _hopeful(columns: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Without documents that share too little with all others to have a partner in a list.

    The need is least for partners of the most different size, so the list's smallest and largest sizes bound it.
    """
    rank, n = columns["rank"], columns["n"]
    opens = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1]))) if len(rank) else rank
    count = np.diff(np.append(opens, len(rank)))
    least = np.repeat(np.minimum.reduceat(n, opens), count) if len(rank) else n
    most = np.repeat(np.maximum.reduceat(n, opens), count) if len(rank) else n
    fewest = np.repeat(np.minimum.reduceat(columns["matches"], opens), count) if len(rank) else n
    small, large = np.maximum(least, least_shared(n)), np.minimum(most, 100 * n // PERCENT)
    need = np.minimum(needed_in_prefixes(n, columns["matches"], small, fewest),
                      needed_in_prefixes(n, columns["matches"], large, fewest))
    # One less, for what the bound rounds up at sizes in between.
    keep = (columns["common"] >= need - 1) & (np.repeat(count, count) > 1)
    return {name: column[keep] for name, column in columns.items()}


def _counted(a, ca, b, cb, need) -> dict:
    order = np.lexsort((b, a))
    a, ca, b, cb, need = a[order], ca[order], b[order], cb[order], need[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    shared = np.diff(np.append(at, len(a)))
    return {"a": pa.array(a[at], pa.int64()), "ca": pa.array(ca[at], pa.int32()),
            "b": pa.array(b[at], pa.int64()), "cb": pa.array(cb[at], pa.int32()),
            "shared": pa.array(shared, pa.int32()), "need": pa.array(need[at], pa.int32())}


def _most_shared(maps: np.ndarray, common: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """At most so many prefix shingles are in both documents of a pair."""
    lacking, other = np.zeros(len(i), dtype=np.int64), np.zeros(len(i), dtype=np.int64)
    for word in range(MAP_WORDS):
        x, y = maps[i, word], maps[j, word]
        lacking += np.bitwise_count(x & ~y)
        other += np.bitwise_count(y & ~x)
    return np.minimum(common[i] - lacking, common[j] - other)


def _leader_pairs(buckets: int):
    """Each document with the one of its list and size class that has the fewest prefix shingles of its own.

    A group of hot lists also puts out its leaders, to be merged with those of the lists' other groups.
    """
    def pairs(table: pa.Table) -> pa.Table:
        c = _read_lists(table)
        size = np.floor(np.log(np.maximum(c["n"], 1)) / np.log(100 / PERCENT)).astype(np.int64)
        own = c["n"] - least_shared(c["n"]) + c["matches"] - c["common"]
        order = np.lexsort((c["key"], own, size, c["rank"]))
        rank, size, key, chunk, token, own = (x[order] for x in (c["rank"], size, c["key"], c["chunk"], c["token"], own))
        opens = np.concatenate(([True], (rank[1:] != rank[:-1]) | (size[1:] != size[:-1]))) \
            if len(rank) else np.zeros(0, dtype=bool)
        leader = np.maximum.accumulate(np.where(opens, np.arange(len(rank)), 0))
        other = key != key[leader]
        at = leader[other]
        found = _counted(key[at], chunk[at], key[other], chunk[other], np.ones(len(at), dtype=np.int64))
        first = np.flatnonzero(opens) if table["bucket"][0].as_py() >= buckets else np.zeros(0, dtype=np.int64)
        none, rest = len(found["a"]), pa.nulls(len(first), pa.int64())
        both = {"a": (found["a"], pa.array(key[first])), "ca": (found["ca"], pa.array(chunk[first], pa.int32())), "b": (found["b"], rest),
                "cb": (found["cb"], rest.cast(pa.int32())), "shared": (found["shared"], rest.cast(pa.int32())),
                "need": (found["need"], rest.cast(pa.int32())), "token": (pa.nulls(none, pa.int64()), pa.array(token[first])),
                "size": (pa.nulls(none, pa.int32()), pa.array(size[first], pa.int32())),
                "own": (pa.nulls(none, pa.int64()), pa.array(own[first], pa.int64()))}
        return pa.table({name: pa.chunked_array(parts) for name, parts in both.items()})
    return pairs


def _cross_pairs(buckets: int):
    """Pairs of one token and different labels, with how many tokens of this bucket they share."""
    def pairs(table: pa.Table) -> pa.Table:
        # Two documents that go to every group of a hot list meet in the first of these alone.
        return _pairs_across(_read_lists(table), table["bucket"][0].as_py() >= 2 * buckets)
    return pairs


def _pairs_across(c: dict[str, np.ndarray], met: bool) -> pa.Table:
    order = np.lexsort((c["label"], c["rank"]))
    rank, key, label, n, matches, common, long, maps, chunk, copied = (
        c[name][order] for name in ("rank", "key", "label", "n", "matches", "common", "long", "map", "chunk", "copied"))
    index = np.arange(len(rank))
    group_end = np.searchsorted(rank, rank, side="right")
    turns = np.flatnonzero(np.concatenate(((rank[1:] != rank[:-1]) | (label[1:] != label[:-1]), [True]))) + 1 \
        if len(rank) else index
    run_end = turns[np.searchsorted(turns, index, side="right")] if len(rank) else index
    count = group_end - run_end
    found, low = [tuple(np.zeros(0, dtype=np.int64) for _ in range(5))], 0
    total = np.cumsum(count)
    while low < len(rank):
        high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + PAIRS_AT_ONCE, "right")))
        part = count[low:high]
        i = np.repeat(index[low:high], part)
        j = np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part) + np.repeat(run_end[low:high], part)
        need = needed_in_prefixes(n[i], matches[i], n[j], matches[j])
        fit = (100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j])) & (np.minimum(common[i], common[j]) >= need)
        if met:
            fit &= ~(copied[i] & copied[j])
        i, j, need = i[fit], j[fit], need[fit]
        fit = ~long[i]
        check = np.flatnonzero(long[i])
        fit[check] = _most_shared(maps, common, i[check], j[check]) >= need[check]
        i, j, need = i[fit], j[fit], need[fit]
        swap = key[i] > key[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        found.append((key[i], chunk[i], key[j], chunk[j], need))
        low = high
    return pa.table(_counted(*(np.concatenate(column) for column in zip(*found))))


def _send_texts(packs: pa.Table, requests: pa.Table) -> pa.Table:
    schema = pa.schema([("chunk", pa.int32()), ("a", pa.int64()), ("text", pa.string()),
                        ("bs", pa.list_(pa.int64()))])
    if not packs.num_rows or not requests.num_rows:
        return schema.empty_table()
    table = unpack(packs["pack"].to_pylist())
    keys, _ = _node_keys(table)
    first = np.searchsorted(np.sort(keys), requests["a"].to_numpy())
    rows = np.argsort(keys, kind="stable")[first]
    return pa.table({"chunk": requests["cb"], "a": requests["a"], "text": table["text"].take(pa.array(rows)),
                     "bs": requests["bs"]}).cast(schema)


def _verify(packs: pa.Table, sent: pa.Table) -> pa.Table:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    if not packs.num_rows or not sent.num_rows:
        return schema.empty_table()
    table = unpack(packs["pack"].to_pylist())
    keys, _ = _node_keys(table)
    partners = sent["bs"].to_pylist()
    wanted = np.unique(np.concatenate([np.array(p, dtype=np.int64) for p in partners]))
    rows = np.argsort(keys, kind="stable")[np.searchsorted(np.sort(keys), wanted)]
    values, ends = _sets(table["text"].take(pa.array(rows)))
    place = {key: i for i, key in enumerate(wanted.tolist())}
    mine, my_ends = _sets(sent["text"])
    a_out, b_out = [], []
    for i, (a, bs) in enumerate(zip(sent["a"].to_pylist(), partners)):
        x = mine[my_ends[i]:my_ends[i + 1]]
        for b in bs:
            y = values[ends[place[b]]:ends[place[b] + 1]]
            at = np.searchsorted(x, y)
            both = int(np.count_nonzero(x[np.minimum(at, len(x) - 1)] == y)) if len(x) else 0
            if both and 100 * both >= PERCENT * (len(x) + len(y) - both):
                a_out.append(a)
                b_out.append(b)
    return pa.table({"a": a_out, "b": b_out}, schema=schema)


def _verified(chunks: DataFrame, pairs: DataFrame) -> DataFrame:
    requests = pairs.groupBy(F.col("ca").alias("chunk"), "a", "cb").agg(F.collect_list("b").alias("bs"))
    sent = chunks.groupBy("chunk").cogroup(requests.groupBy("chunk")).applyInArrow(_send_texts, _TEXTS)
    return chunks.groupBy("chunk").cogroup(sent.groupBy("chunk")).applyInArrow(_verify, "a long, b long")


def _linked(chunks: DataFrame, size: Extent) -> DataFrame:
    """chunk, key, same, doc_id, n and top (the smallest key of the component) of every row, written and read back."""
    spark = chunks.sparkSession
    buckets, shift = size.buckets, max(0, 64 - (max(1, size.n_bytes).bit_length() + 12))
    described = stored(chunks.mapInArrow(_describe, _ROWS), "described")
    rows = described.filter("kind = 0").drop("kind", "blob")
    if rows.groupBy("key").count().filter("count > 1").limit(1).count():
        rows = stored(chunks.groupBy("chunk").applyInArrow(_described_again, _ROWS), "described").drop("kind", "blob")
    frequency = spark.sparkContext.broadcast(frequency_sketch(described))
    sets = rows.filter("n > 0")
    # Stored, so that the join with the members below has an exchange on both sides and a hot class is split there.
    classes = stored(sets.groupBy("n", "d1", "d2").agg(F.min(F.struct("key", "chunk")).alias("first")), "classes")
    nodes = classes.select("first.key", "first.chunk")

    tokens = chunks.groupBy("chunk").cogroup(nodes.withColumn("label", F.col("key")).groupBy("chunk")) \
        .applyInArrow(_send_tokens(frequency, buckets, shift), _LISTS)
    shared = stored(tokens.groupBy("bucket").applyInArrow(_shared_tokens(HOT_LIST), _LISTS + ", hot boolean"), "shared")
    hot = bool(shared.filter("hot").limit(1).count())

    def answers(rows: DataFrame, kind: int) -> DataFrame:
        return rows.select("chunk", F.lit(None).cast("long").alias("key"), F.lit(None).cast("long").alias("label"),
                           "bucket", "blob", F.lit(kind).alias("kind"))

    def asked(labelled: DataFrame) -> DataFrame:
        return labelled.select("chunk", "key", "label", F.lit(None).cast("int").alias("bucket"),
                               F.lit(None).cast("binary").alias("blob"), F.lit(0).alias("kind"))

    def sent(work, inputs: DataFrame) -> DataFrame:
        return chunks.groupBy("chunk").cogroup(inputs.groupBy("chunk")).applyInArrow(work, _LISTS)

    inputs = asked(nodes.withColumn("label", F.col("key"))).union(answers(shared, 1))
    leaders = sent(_send_lists(frequency, buckets, shift, False), inputs).groupBy("bucket").applyInArrow(_leader_pairs(buckets), _LEADERS)
    leaders = stored(leaders, "leaders") if hot else leaders
    best = leaders.filter("token is null").groupBy("a", "ca", "b", "cb").agg(F.sum("shared").alias("shared")) \
        .groupBy("b", "cb").agg(F.max(F.struct("shared", (-F.col("a")).alias("minus"), "ca")).alias("top")) \
        .select((-F.col("top.minus")).alias("a"), "top.ca", "b", "cb")
    if hot:
        first = leaders.filter("token is not null").groupBy("token", "size").agg(F.min(F.struct("own", "a", "ca")).alias("first"))
        merged = leaders.filter("token is not null").select("token", "size", F.col("a").alias("b"), F.col("ca").alias("cb")) \
            .join(first, ["token", "size"]).select("first.a", "first.ca", "b", "cb").filter("a <> b")
        best = best.union(merged).distinct()
    links = stored(_verified(chunks, best), "verified")
    labels = components(links)
    labelled = nodes.join(labels.withColumnRenamed("v", "key"), "key", "left") \
        .select("key", "chunk", F.coalesce("label", "key").alias("label"))
    inputs = asked(labelled).union(answers(shared, 1))
    if hot:
        held = asked(labelled).union(answers(shared.join(shared.filter("hot").select("chunk").distinct(), "chunk", "left_semi"), 1))
        majorities = sent(_send_labels(frequency, buckets, shift), held).groupBy("bucket").applyInArrow(_majorities, _LISTS)
        inputs = inputs.union(answers(stored(majorities, "majorities"), 2))
    cross = sent(_send_lists(frequency, buckets, shift, True), inputs).groupBy("bucket").applyInArrow(_cross_pairs(buckets), _PAIRS)
    rest = cross.groupBy("a", "ca", "b", "cb") \
        .agg(F.sum("shared").alias("shared"), F.max("need").alias("need")).filter("shared >= need")
    more = stored(_verified(chunks, rest), "verified")
    members = sets.join(classes, ["n", "d1", "d2"]).select(F.col("first.key").alias("a"), F.col("key").alias("b"))
    ids = sets.select(F.col("same").alias("a"), F.col("key").alias("b"))
    labels = components(links.union(more).union(members.union(ids).filter("a <> b")))
    return stored(rows.join(labels.withColumnRenamed("v", "key"), "key", "left").select(
        "chunk", "key", "same", "doc_id", "n", F.coalesce("label", "same").alias("top")), "components")


def similar_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    size = extent(docs)
    chunks = into_chunks(docs, size.chunks).persist(StorageLevel.DISK_ONLY)
    linked = _linked(chunks, size)
    chunks.unpersist()
    return linked.select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                         F.when(F.col("top") < NO_ID, F.col("top")).alias("component_id"))


def first_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with the smallest document of every component, with all its rows but repeated ones; rows without
    words all stay.

    The packs of texts stay on the executors' disks until the session's cache is cleared.
    """
    size = extent(docs)
    chunks = into_chunks(docs, size.chunks).persist(StorageLevel.DISK_ONLY)
    linked = _linked(chunks, size)
    kept = linked.filter("n = 0 or same = top").groupBy("chunk", "key").agg(F.max(F.col("n") == 0).alias("all"))
    schema = docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")}).schema
    return chunks.groupBy("chunk").cogroup(kept.groupBy("chunk")).applyInArrow(_keep(to_arrow_schema(schema)), schema)


def _keep(schema: pa.Schema):
    def keep(packs: pa.Table, kept: pa.Table) -> pa.Table:
        if not packs.num_rows or not kept.num_rows:
            return schema.empty_table()
        table = unpack(packs["pack"].to_pylist())
        keys, _ = _node_keys(table)
        wanted = dict(zip(kept["key"].to_pylist(), kept["all"].to_pylist()))
        new = np.concatenate(([True], keys[1:] != keys[:-1])).tolist()
        rows = [i for i, key in enumerate(keys.tolist()) if key in wanted and (new[i] or wanted[key])]
        return table.take(pa.array(rows, pa.int64())).cast(schema)
    return keep


def _described_again(packs: pa.Table) -> pa.Table:
    """As ``_describe``, for tables in which a doc_id occurs again: chunk by chunk, with a key for each text."""
    table = unpack(packs["pack"].to_pylist())
    keys, same = _node_keys(table)
    values, ends = _sets(table["text"])
    n, digests = len(table), _digests(values, ends)
    return pa.table({"kind": np.zeros(n, np.int32), "chunk": np.full(n, packs["chunk"][0].as_py(), np.int32),
                     "key": keys, "same": same, "doc_id": table["doc_id"], "n": np.diff(ends).astype(np.int32),
                     "d1": digests[0], "d2": digests[1], "blob": pa.nulls(n, pa.binary())})
