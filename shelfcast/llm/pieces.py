"""SentencePiece encoding and decoding of whole texts, as the library does it for byte-pair models.

Method: vectorised merge rounds.  A text is cut where no piece of the vocabulary can reach across (before a run
of spaces, around line ends), and each different segment is encoded once for each worker.  Its characters lie in one
flat symbol array with those of all other new segments.  A round looks up the rank of every neighbouring
pair, takes the smallest rank of each segment, merges its leftmost occurrences at once, and compacts; a segment
without a pair leaves.  Merging several occurrences in one round equals merging them one after the other unless a merge makes a
pair of the same or a better rank; such a segment merges only its first occurrence in that round.

Defined results.  Null text counts as empty; an empty text has only the begin and end ids.  Rows are independent:
repeated rows and rows without doc_id give a row each.  Other columns are ignored.  Empty table: no rows.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.chunks import ship
from shelfcast.llm.segments import SegmentCache
from shelfcast.llm.words import slices, text_bytes

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
NO_PAIR = np.iinfo(np.int32).max
SCHEMA = "doc_id long, ids binary, decoded string"


class Pieces:
    """The tables of one model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        rules = proto.normalizer_spec
        if (proto.trainer_spec.model_type != 2 or rules.precompiled_charsmap or rules.remove_extra_whitespaces
                or not rules.add_dummy_prefix or not rules.escape_whitespaces or not proto.trainer_spec.byte_fallback
                or any(p.type not in (NORMAL, UNKNOWN, CONTROL, BYTE) for p in proto.pieces)):
            raise ValueError(f"{path} is not a byte-pair model with byte fallback and unchanged text")
        kinds = [p.type for p in proto.pieces]
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.size = len(proto.pieces)
        self.begin, self.end = proto.trainer_spec.bos_id, proto.trainer_spec.eos_id
        self.unknown = kinds.index(UNKNOWN)
        self.cut_spaces = not any(SPACE in piece.lstrip(SPACE) for piece in normal)
        self.cut_lines = not any("\n" in piece for piece in normal)
        self.of_char = np.full(0x110000, -1, dtype=np.int32)
        for piece, i in normal.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
        if any(self.of_char[ord(char)] < 0 for piece in normal for char in piece):
            raise ValueError(f"{path} has a piece with a character that is no piece")
        scores = sorted({proto.pieces[i].score for i in normal.values()}, reverse=True)
        rank_of = {score: rank for rank, score in enumerate(scores)}
        pairs = {}
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = normal.get(piece[:cut]), normal.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = (rank_of[proto.pieces[i].score], i)
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.pairs.tolist()], dtype=np.int32)
        self.merged = np.array([pairs[k][1] for k in self.pairs.tolist()], dtype=np.int32)
        self.byte_ids = np.full(256, self.unknown, dtype=np.int32)
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
        self.is_byte = np.array([k == BYTE for k in kinds])
        surface = [b"" if k == CONTROL else bytes([int(p.piece[3:5], 16)]) if k == BYTE
                   else proto.trainer_spec.unk_surface.encode() if k == UNKNOWN
                   else p.piece.replace(SPACE, " ").encode() for k, p in zip(kinds, proto.pieces)]
        self.surface = np.frombuffer(b"".join(surface), dtype=np.uint8)
        self.surface_ends = np.cumsum([0, *map(len, surface)])

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of neighbouring symbols; NO_PAIR where no piece joins them."""
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        known = (self.pairs[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(known, self.ranks[at], NO_PAIR), self.merged[at]

    def merge_rounds(self, symbols: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge every word (a run of equal numbers in ``words``) until no pair is left.

        Unmergeable symbols are negative.  Returns the symbols and their words, words ascending.
        """
        done = []
        while len(symbols):
            rank, merged = self.look_up(symbols[:-1], symbols[1:])
            rank = np.append(np.where(words[:-1] == words[1:], rank, NO_PAIR), NO_PAIR)
            merged = np.append(merged, -1)
            opens = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
            sizes = np.diff(np.append(opens, len(words)))
            least = np.repeat(np.minimum.reduceat(rank, opens), sizes)
            over = least == NO_PAIR
            if over.any():
                done.append((symbols[over], words[over]))
                symbols, words, rank, merged, least = (x[~over] for x in (symbols, words, rank, merged, least))
                if not len(symbols):
                    break
            chosen = self._leftmost(rank == least)
            at = np.flatnonzero(chosen)
            several = np.flatnonzero(np.diff(words[at]) == 0)
            if len(several):
                again = np.isin(words, words[at[several]])
                spoilt = self._spoilt(symbols, words, chosen & again, merged, least)
                if len(spoilt):
                    later = np.concatenate(([False], words[at][1:] == words[at][:-1]))
                    chosen[at[later & np.isin(words[at], spoilt)]] = False
                    at = np.flatnonzero(chosen)
            symbols = symbols.copy()
            symbols[at] = merged[at]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            symbols, words = symbols[keep], words[keep]
        if not done:
            return symbols, words
        symbols, words = (np.concatenate(parts) for parts in zip(*done))
        order = np.argsort(words, kind="stable")
        return symbols[order], words[order]

    @staticmethod
    def _leftmost(wanted: np.ndarray) -> np.ndarray:
        """Of overlapping wanted pairs (neighbours), every second one from the left."""
        index = np.arange(len(wanted))
        begins = wanted & ~np.concatenate(([False], wanted[:-1]))
        since = index - np.maximum.accumulate(np.where(begins, index, 0))
        return wanted & (since % 2 == 0)

    def _spoilt(self, symbols, words, chosen, merged, least) -> np.ndarray:
        """Words in which one of several merges makes a pair of the same or a better rank."""
        at = np.flatnonzero(chosen)
        after = np.minimum(at + 2, len(symbols) - 1)
        right, _ = self.look_up(merged[at], symbols[after])
        right = np.where((at + 2 < len(symbols)) & (words[after] == words[at]), right, NO_PAIR)
        ended = np.zeros(len(symbols), dtype=bool)
        ended[at + 1] = True
        final = np.where(chosen, merged, symbols)
        before = np.maximum(at - 1, 0)
        before = np.where(ended[before], np.maximum(at - 2, 0), before)
        left, _ = self.look_up(final[before], merged[at])
        left = np.where((before < at) & (words[before] == words[at]), left, NO_PAIR)
        return np.unique(words[at[np.minimum(left, right) <= least[at]]])

    def encode_segments(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments one after the other, and how many each has."""
        text = b"\n".join(segments).decode("utf-8").replace(" ", SPACE)
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        sizes = np.array([len(s.decode("utf-8")) for s in segments], dtype=np.int64)
        begins = np.cumsum(sizes + 1) - sizes - 1
        words = np.repeat(np.arange(len(segments)), sizes)
        codes = codes[np.arange(sizes.sum()) + np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)]
        symbols = self.of_char[codes]
        symbols = np.where(symbols < 0, -1 - codes.astype(np.int64), symbols).astype(np.int32)
        symbols, words = self.merge_rounds(symbols, words)
        return self._fall_back(symbols, words, len(segments))

    def _fall_back(self, symbols, words, n: int):
        foreign = np.flatnonzero(symbols < 0)
        if len(foreign):
            spelled = [chr(-1 - s).encode("utf-8") for s in symbols[foreign].tolist()]
            widths = np.ones(len(symbols), dtype=np.int64)
            widths[foreign] = [len(s) for s in spelled]
            ids = np.repeat(symbols, widths)
            ids[ids < 0] = self.byte_ids[np.frombuffer(b"".join(spelled), dtype=np.uint8)]
            symbols, words = ids, np.repeat(words, widths)
        return symbols, np.bincount(words, minlength=n)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Text of each run of ids ends[i]:ends[i + 1]."""
        widths = (self.surface_ends[1:] - self.surface_ends[:-1])[ids]
        sums = np.concatenate(([0], np.cumsum(widths)))
        at = np.arange(sums[-1]) + np.repeat(self.surface_ends[:-1][ids] - sums[:-1], widths)
        data = self.surface[at].tobytes()
        out = []
        from_bytes = np.concatenate(([0], np.cumsum(self.is_byte[ids])))[ends]
        for i, (low, high) in enumerate(zip(sums[ends[:-1]].tolist(), sums[ends[1:]].tolist())):
            text = data[low:high]
            if text[:1] == b" ":
                first = ids[ends[i]:ends[i + 1]]
                first = first[self.surface_ends[first + 1] > self.surface_ends[first]][0]
                text = text if self.is_byte[first] else text[1:]
            if from_bytes[i + 1] > from_bytes[i]:
                text = _valid(text)
            out.append(text)
        return out


def _one_byte_on(error: UnicodeDecodeError) -> tuple[str, int]:
    return "\ufffd", error.start + 1


codecs.register_error("shelfcast-each-byte", _one_byte_on)


def _valid(text: bytes) -> bytes:
    """Bytes that spell no character become U+FFFD each, as the library has it."""
    return text.decode("utf-8", errors="shelfcast-each-byte").encode()


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Encoder:
    """Encodes batches of texts; remembers the segments it has seen."""

    def __init__(self, model: Pieces):
        self.model = model
        self.cache = SegmentCache(model.encode_segments)

    def _segments(self, data: np.ndarray, offsets: np.ndarray):
        """Texts with the leading space that the model adds, and where their segments start."""
        full = np.flatnonzero(np.diff(offsets))
        data = np.insert(data, offsets[full], 32)
        first = offsets[full] + np.arange(len(full))
        opens = np.zeros(len(data), dtype=bool)
        before = np.concatenate((np.zeros(1, dtype=np.uint8), data[:-1]))
        if self.model.cut_spaces:
            # 0x81 ends the sign that stands for a space; such a place is left uncut to be safe.
            opens |= (data == 32) & (before != 32) & (before != 0x81)
        if self.model.cut_lines:
            opens |= (data == 10) | (before == 10)
        opens[first] = True
        return data, np.flatnonzero(opens), full, first

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents, each with its begin and end id, and n_docs + 1 offsets."""
        n = len(offsets) - 1
        data, starts, full, first = self._segments(data, offsets)
        body, sums = self.cache.ids_of(data, starts)
        sizes = np.zeros(n, dtype=np.int64)
        sizes[full] = np.diff(np.append(sums[np.searchsorted(starts, first)], sums[-1]))
        offsets = np.concatenate(([0], np.cumsum(sizes + 2)))
        out = np.empty(offsets[-1], dtype=np.int32)
        inside = np.ones(len(out), dtype=bool)
        out[offsets[:-1]], out[offsets[1:] - 1] = self.model.begin, self.model.end
        inside[offsets[:-1]] = inside[offsets[1:] - 1] = False
        out[inside] = body
        return out, offsets


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(pieces(path))


def _round_trip(path: str):
    def work(batches) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            data, offsets = text_bytes(batch["text"])
            for low, high in slices(offsets):
                part = offsets[low:high + 1]
                ids, ends = own.encode(data[part[0]:part[-1]], part - part[0])
                raw = ids.astype("<u4").tobytes()
                spans = (4 * ends).tolist()
                yield pa.record_batch([
                    batch["doc_id"][low:high], pa.array([raw[a:b] for a, b in zip(spans[:-1], spans[1:])], pa.binary()),
                    pa.array(own.model.decode(ids, ends), pa.binary()).cast(pa.string())],
                    names=["doc_id", "ids", "decoded"])
    return work


def encode_and_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit), and the text decoded from them, for every row."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_round_trip(path), SCHEMA)


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
