"""Ids of text segments, each different segment encoded once for each worker."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from shelfcast.llm.words import byte_hashes

MOST_KEPT = 1 << 19
"""A worker forgets its encoded segments beyond so many; this bounds memory, not results."""


class SegmentCache:
    """Remembers the ids of the segments it has seen.  ``encode`` gives ids and counts of a list of segments.

    Segments are known by one hash and checked by a second; where two different ones share the first, all of the
    call are encoded anew.  ``most`` stands in for MOST_KEPT.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int | None = None):
        self.encode, self.most = encode, most
        self.forget()

    def forget(self) -> None:
        self.known, self.checks = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
        self.begins, self.counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int32)

    def ids_of(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the segments that begin at ``starts`` (each ends where the next begins), and len(starts) + 1 offsets."""
        ends = np.append(starts[1:], len(data))
        hashes, checks = byte_hashes(data, starts, ends), byte_hashes(data, starts, ends, 1)
        # Only the different hashes are sorted.
        coded = pa.array(hashes).dictionary_encode()
        unique, inverse = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        ascending = np.argsort(unique)
        where = np.flatnonzero(np.diff(np.maximum.accumulate(inverse), prepend=-1))[ascending]
        unique = unique[ascending]
        if len(self.known) > (self.most or MOST_KEPT):
            self.forget()
        at = np.searchsorted(self.known, unique)
        seen = at < len(self.known)
        seen[seen] = self.known[at[seen]] == unique[seen]
        fresh = where[~seen]
        if len(fresh):
            ids, counts = self._encoded(data, starts[fresh], ends[fresh])
            begins = len(self.ids) + np.cumsum(counts) - counts
            known = np.concatenate((self.known, hashes[fresh]))
            order = np.argsort(known, kind="stable")
            self.known = known[order]
            self.checks = np.concatenate((self.checks, checks[fresh]))[order]
            self.begins = np.concatenate((self.begins, begins))[order]
            self.counts = np.concatenate((self.counts, counts))[order]
            self.ids = np.concatenate((self.ids, ids.astype(np.int32)))
        at = np.empty(len(unique), dtype=np.int64)
        at[ascending] = np.searchsorted(self.known, unique)
        at = at[inverse]
        if (self.checks[at] != checks).any():
            ids, counts = self._encoded(data, starts, ends)
            return ids.astype(np.int32), np.concatenate(([0], np.cumsum(counts)))
        counts = self.counts[at]
        sums = np.concatenate(([0], np.cumsum(counts)))
        return self.ids[np.arange(sums[-1]) + np.repeat(self.begins[at] - sums[:-1], counts)], sums

    def _encoded(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        return self.encode([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())])
