"""Context-mixing range coder for token ids, many blocks in step.

A block holds BLOCK ids and is coded on its own, and its ids carry a checksum.  numpy works on one id of every block at a
time, so a section of three thousand blocks moves three thousand coders with each operation.

An id is one symbol.  Order 0 gives each id its share of TOTAL, by its count in all blocks (``shares``).  Orders 1 and 2 each
predict one id, the one last seen after the same one or two ids in this block, with a confidence of 0 to 3; order 1 begins with what mostly
follows (``followers``), order 2 with nothing.  The caller keeps shares and followers beside the blocks.  Mixing: each predicted id
gets an extra share on top of its own, in proportion to how often that order has been right in this block at these two
confidences, counted apart where both orders agree.  The mixed shares drive a carryless range coder with a 48-bit state that puts out 16 bits
at a time.

Sums and products are whole numbers below 2**53, which double precision holds exactly, and its quotients are the same on
every machine.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 2048
ALPHABET = 1 << 16
TOTAL = 1 << 20
MOST_EXTRA = np.float32(7 * TOTAL)
"""Of one order, so that all shares together stay below BOTTOM."""
CONTEXTS = 1 << 12
MOST_LANES = 4096
LEARNT_IDS = 1 << 19
WIDTH = (1 << 48) - 1
TOP, BOTTOM = 1 << 32, 1 << 24
EVEN = np.full(ALPHABET, TOTAL // ALPHABET)
"""The shares where nothing is known of the ids."""
UNKNOWN = np.zeros(CONTEXTS, dtype=np.uint16)
# Misses, hits of order 1 and of order 2 that a cell begins with, without and with agreement; a hit weighs TOTAL.
_BEGIN = np.array([[2, TOTAL / 2, TOTAL / 2, 0], [2, TOTAL / 2, 0, 0]], dtype=np.float32)
_MORE = np.array([[1, 0, 0, 0], [0, TOTAL, 0, 0], [0, 0, TOTAL, 0], [0, TOTAL, 0, 0]], dtype=np.float32)
# What a confidence changes by, after a miss and after a hit.
_SURER = np.array([0, 0, -1, -1, 1, 1, 1, 0], dtype=np.int32)


def shares(times: np.ndarray) -> np.ndarray:
    """Shares of TOTAL, at least one each, of ids that occur so often."""
    times = np.asarray(times, dtype=np.int64)
    if not len(times):
        return times
    out = 1 + (times * ((TOTAL - len(times)) / times.sum())).astype(np.int64)
    out[np.argmax(times)] += TOTAL - out.sum()
    return out


def followers(ids: np.ndarray) -> np.ndarray:
    """The id that mostly follows in each context of order 1, by the first LEARNT_IDS ids; 0 where none was seen."""
    some = ids[:LEARNT_IDS].astype(np.int64)
    pairs, times = np.unique((some[:-1] & CONTEXTS - 1) << 16 | some[1:], return_counts=True)
    pairs = pairs[np.argsort(times, kind="stable")]
    out = UNKNOWN.copy()
    # Of several values for one context the last one stays, which is the most frequent.
    out[pairs >> 16] = pairs & 0xFFFF
    return out


class _Lanes:
    """Models and coder states of some blocks."""

    def __init__(self, n: int, share: np.ndarray, first: np.ndarray):
        self.n = n
        self.share = share.astype(np.float64)
        self.begin = np.cumsum(self.share) - self.share
        # An id and its confidence of 0 to 3 in the lowest two bits, by order and context.
        self.guess = np.zeros(2 * n * CONTEXTS, dtype=np.int32)
        self.guess.reshape(2, n, CONTEXTS)[0] = first.astype(np.int32) << 2 | (first > 0)
        self.record = np.tile(_BEGIN, (n * 16, 1)).view(np.complex128).ravel()
        self.context0 = np.arange(2 * n).reshape(2, n) * CONTEXTS
        self.record0 = np.arange(n) * 32
        self.low = np.zeros(n, dtype=np.int64)
        self.span = np.full(n, WIDTH, dtype=np.int64)
        self.mark = np.zeros(n, dtype=np.int64)
        self.places = self.context0.copy()

    def shrink(self, n: int) -> None:
        """Go on with the first ``n`` blocks."""
        self.n = n
        for name in ("context0", "record0", "low", "span", "mark", "places"):
            setattr(self, name, np.ascontiguousarray(getattr(self, name)[..., :n]))

    def code_id(self, id_of, renormalise) -> np.ndarray:
        """Code one id of every block.  ``id_of`` gives the ids (encoder) or finds them (decoder)."""
        held = self.guess.take(self.places)
        guesses, faiths = held >> 2, held & 3
        cell = ((faiths[0] << 2 | faiths[1]) << 1 | (guesses[0] == guesses[1])) + self.record0
        row = self.record.take(cell)
        odds = row.view(np.float32).reshape(-1, 4)
        extra = np.floor(np.minimum(odds.T[1:3] / odds.T[0], MOST_EXTRA)).astype(np.float64)
        begins = self.begin.take(guesses)
        total = extra[0] + extra[1]
        total += TOTAL
        part = np.floor(self.span.astype(np.float64) / total)
        found = id_of(part, extra, begins)
        below, size = self.begin.take(found), self.share.take(found)
        moved = extra * (begins < below)
        hit = guesses == found
        gained = extra * hit
        below += moved[0]
        below += moved[1]
        size += gained[0]
        size += gained[1]
        below *= part
        size *= part
        # How far the lower end moves up.
        self.step = below.astype(np.int64)
        self.low += self.step
        self.span = size.astype(np.int64)
        renormalise(self)
        hits = hit.view(np.uint8)
        odds += _MORE.take(hits[0] | hits[1] << 1, axis=0)
        self.record[cell] = row
        code = faiths | hit << np.int32(2)
        held += _SURER.take(code)
        fresh = found.astype(np.int32) << 2 | 1
        held = np.where(code > 1, held, fresh)
        self.guess[self.places] = held
        self.places[0] = found & CONTEXTS - 1
        mark = found * 0x85EB
        self.places[1] = (mark ^ self.mark >> 3) >> 2 & CONTEXTS - 1
        self.places += self.context0
        self.mark = mark
        return found

    def settled(self) -> np.ndarray:
        """Whether the upper 16 bits of each block are settled."""
        return (self.low ^ (self.low + self.span)) < TOP

    def shift(self, bits: np.ndarray) -> None:
        self.low <<= bits
        self.low &= WIDTH
        self.span <<= bits

    def cut(self, move) -> None:
        """Shift blocks whose range is too small, first cut so that their upper 16 bits are settled; ``move`` is told which."""
        if self.span.min() >= BOTTOM:
            return
        at = np.flatnonzero(self.span < BOTTOM)
        while len(at):
            move(at)
            low, span = self.low[at], self.span[at]
            span = np.where((low ^ (low + span)) < TOP, span, -low & (BOTTOM - 1)) << 16
            self.low[at], self.span[at] = (low << 16) & WIDTH, span
            at = at[span < BOTTOM]


def block_length(n: int) -> int:
    """Shorter blocks for a short run of ids, so that enough of them go in step."""
    return min(BLOCK, max(BLOCK // 8, -(-n // 256)))


def _block_sizes(n: int, block: int) -> np.ndarray:
    sizes = np.full(-(-n // block), block, dtype=np.int64)
    if len(sizes):
        sizes[-1] = n - block * (len(sizes) - 1)
    return sizes


def encode(ids: np.ndarray, block: int = BLOCK, share: np.ndarray = EVEN, first: np.ndarray = UNKNOWN) -> list[bytes]:
    """One coded block for every ``block`` ids below the number of shares: checksum, then 16-bit words."""
    out = []
    per_run = MOST_LANES * block
    for begin in range(0, len(ids), per_run):
        out += _encode_lanes(np.ascontiguousarray(ids[begin:begin + per_run]), block, share, first)
    return out


def _encode_lanes(ids: np.ndarray, block: int, share: np.ndarray, first: np.ndarray) -> list[bytes]:
    sizes = _block_sizes(len(ids), block)
    padded = np.zeros(len(sizes) * block, dtype=np.uint16)
    padded[:len(ids)] = ids
    columns = np.ascontiguousarray(padded.reshape(len(sizes), block).T)
    lanes = _Lanes(len(sizes), share, first)
    owners, words = [], []

    def put(at: np.ndarray, low: np.ndarray) -> None:
        owners.append(at.astype(np.uint16))
        words.append((low >> 32).astype("<u2"))

    def renormalise(state: _Lanes) -> None:
        settled = state.settled()
        at = np.flatnonzero(settled)
        put(at, state.low.take(at))
        state.shift(settled * np.int64(16))
        state.cut(lambda at: put(at, state.low[at]))

    def flush(low: np.ndarray, lane: int) -> None:
        for bits in (0, 16, 32):
            put(np.arange(lane, lane + len(low)), low << bits & WIDTH)

    for place in range(block):
        if place == sizes[-1]:
            flush(lanes.low[lanes.n - 1:], lanes.n - 1)
            lanes.shrink(lanes.n - 1)
            if not lanes.n:
                break
        now = columns[place, :lanes.n].astype(np.int64)
        lanes.code_id(lambda *_, now=now: now, renormalise)
    flush(lanes.low, 0)
    owner, word = np.concatenate(owners), np.concatenate(words)
    word = word[np.argsort(owner, kind="stable")]
    cuts = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(sizes))))).tolist()
    ends = np.cumsum(sizes)
    raw = ids.astype("<u4").tobytes()
    return [zlib.crc32(raw[4 * (end - size):4 * end]).to_bytes(4, "little") + word[a:b].tobytes()
            for size, end, a, b in zip(sizes.tolist(), ends.tolist(), cuts[:-1], cuts[1:])]


def decode(blocks: list[bytes], n: int, block: int = BLOCK, share: np.ndarray = EVEN, first: np.ndarray = UNKNOWN) -> np.ndarray:
    """The ``n`` ids of successive blocks; raises ValueError where a checksum differs."""
    out = []
    for begin in range(0, len(blocks), MOST_LANES):
        part = blocks[begin:begin + MOST_LANES]
        out.append(_decode_lanes(part, min(n - begin * block, len(part) * block), block, share, first))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint16)


def _decode_lanes(blocks: list[bytes], n: int, block: int, share: np.ndarray, first: np.ndarray) -> np.ndarray:
    sizes = _block_sizes(n, block)
    if len(sizes) != len(blocks):
        raise ValueError(f"{n} ids need {len(sizes)} blocks, not {len(blocks)}")
    streams = [np.frombuffer(raw, dtype="<u2", offset=4) for raw in blocks]
    begins = np.concatenate(([0], np.cumsum([len(s) for s in streams])))
    words = np.concatenate([*streams, np.zeros(4, dtype=np.uint16)])
    at_word = begins[:-1].copy()
    # How far the code is above the lower end of the range.
    above = np.zeros(len(blocks), dtype=np.int64)
    ids_at = np.repeat(np.arange(len(share), dtype=np.uint16), share)
    lanes = _Lanes(len(blocks), share, first)

    def take(at: np.ndarray) -> None:
        # A damaged block may run past its end; the checksum tells.
        above[at] = (above[at] << 16 | words.take(at_word[at], mode="clip")) & WIDTH
        at_word[at] += 1

    for _ in range(3):
        take(np.arange(len(blocks)))

    def find(part, extra, begins):
        target = above / part
        inside = begins + extra[::-1] * (begins[::-1] < begins)
        np.subtract(target, inside, out=inside)
        np.maximum(inside, 0, out=inside)
        np.minimum(inside, extra, out=inside)
        target -= inside[0]
        target -= inside[1]
        return ids_at.take(target.astype(np.int64), mode="clip").astype(np.int64)

    def renormalise(state: _Lanes) -> None:
        nonlocal above, at_word
        settled = state.settled()
        bits = settled * np.int64(16)
        state.shift(bits)
        above -= state.step
        above <<= bits
        above |= words.take(at_word, mode="clip") * settled
        above &= WIDTH
        at_word += settled
        state.cut(take)

    columns = np.zeros((block, len(blocks)), dtype=np.uint16)
    for place in range(block):
        if place == sizes[-1]:
            lanes.shrink(lanes.n - 1)
            above, at_word = above[:lanes.n].copy(), at_word[:lanes.n].copy()
            if not lanes.n:
                break
        columns[place, :lanes.n] = lanes.code_id(find, renormalise)
    ids = np.ascontiguousarray(columns.T).reshape(-1)[:n]
    raw = ids.astype("<u4").tobytes()
    for i, (coded, end) in enumerate(zip(blocks, np.cumsum(sizes).tolist())):
        if zlib.crc32(raw[4 * (end - int(sizes[i])):4 * end]) != int.from_bytes(coded[:4], "little"):
            raise ValueError(f"block {i} is damaged")
    return ids
