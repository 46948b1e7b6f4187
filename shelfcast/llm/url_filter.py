"""URL filter: all glob rules at once over every canonical URL, as one bit-parallel automaton.

Method: Shift-And.  A rule's symbols are bits of a row of 64-bit words, next to each other with those of all other rules.
Reading a byte shifts every URL's state by one bit, adds the rules' first bits at the start, and keeps the bits whose
symbol takes that byte; a wildcard's bit also stays where it is.  One numpy step moves the automata of thousands of URLs.  URLs
whose state cannot change any more leave.

The canonical URL is ``.`` + host + path: the host after ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path up to
``?``, ``#`` or the end.  In a glob ``*`` stands for any bytes but ``/`` and ``**`` for any bytes.  A rule ``host/path`` is the glob
``*.host/path**``: the host and its subdomains, and paths that start alike.  Of the rules that fit, the one with
the longest text wins, and of those as long the first.

Defined results.  A null url, or one without ``://``: both parts empty, no rule, the default verdict.  One row for each
input row.  Other columns are ignored.  Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.chunks import ship
from shelfcast.llm.words import text_bytes

AT_ONCE = 1 << 15
"""URLs that step together."""
_U = np.uint64
ANY, ANY_IN_PART, END, SLASH = -2, -1, 256, 47


class Rules:
    """Masks of all rules: for each byte the bits that take it and the wildcard bits that stay on it."""

    def __init__(self, globs: Sequence[str]):
        symbols: list[int] = []
        self.final, first = [], []
        for glob in globs:
            raw, i, before = glob.encode("utf-8"), 0, len(symbols)
            first.append(before)
            while i < len(raw):
                if raw[i:i + 2] == b"**":
                    symbols.append(ANY)
                    i += 2
                elif raw[i:i + 1] == b"*":
                    symbols.append(ANY_IN_PART)
                    i += 1
                else:
                    symbols.append(raw[i])
                    i += 1
            if len(symbols) == before:
                raise ValueError("an empty glob")
            symbols.append(END)
            self.final.append(len(symbols) - 1)
        kinds = np.array(symbols)
        self.words = max(1, -(-len(kinds) // 64))

        def packed(bits: np.ndarray) -> np.ndarray:
            padded = np.zeros(self.words * 64, dtype=np.uint8)
            padded[:len(bits)] = bits
            return np.packbits(padded, bitorder="little").view(_U)

        # Bit i means: the automaton is before symbol i.  The last bit of a rule means that it has fitted.
        self.take = np.array([packed(kinds == byte) for byte in range(256)])
        self.stay = np.array([packed((kinds == ANY) | ((kinds == ANY_IN_PART) & (byte != SLASH))) for byte in range(256)])
        self.skip = packed(kinds < 0)
        self.begin = packed(np.isin(np.arange(len(kinds)), first))
        self.ends = packed(kinds == END)

    @staticmethod
    def _shift(state: np.ndarray) -> np.ndarray:
        out = state << _U(1)
        out[:, 1:] |= state[:, :-1] >> _U(63)
        return out

    def _past_wildcards(self, state: np.ndarray) -> np.ndarray:
        """A wildcard may stand for nothing: from before it to behind it, however many follow each other."""
        while True:
            more = state | self._shift(state & self.skip)
            if np.array_equal(more, state):
                return state
            state = more

    def fitting(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For each text a row of booleans: which rules fit it whole."""
        lengths = np.diff(offsets)
        out = np.zeros((len(lengths), self.words), dtype=_U)
        for low in range(0, len(lengths), AT_ONCE):
            high = min(len(lengths), low + AT_ONCE)
            out[low:high] = self._run(data, offsets[low:high], lengths[low:high])
        bits = np.unpackbits(out.view(np.uint8), axis=1, bitorder="little")
        return bits[:, self.final].astype(bool)

    def _run(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Final states.  A URL leaves at its end or when its state is settled."""
        result = np.zeros((len(starts), self.words), dtype=_U)
        alive = np.arange(len(starts))
        state = self._past_wildcards(np.repeat(self.begin[None, :], len(starts), axis=0))
        for place in range(int(lengths.max(initial=0))):
            over = lengths[alive] <= place
            if over.any():
                result[alive[over]] = state[over]
                alive, state = alive[~over], state[~over]
            byte = data[starts[alive] + place]
            state = self._past_wildcards(self._shift(state & self.take[byte]) | (state & self.stay[byte]))
            settled = ~np.any(state & ~(self.ends | self.stay[SLASH]), axis=1) & self._settled(state)
            if settled.any():
                result[alive[settled]] = state[settled]
                alive, state = alive[~settled], state[~settled]
            if not len(alive):
                break
        result[alive] = state
        return result & self.ends

    def _settled(self, state: np.ndarray) -> np.ndarray:
        """Nothing is left but closing ``**`` and what they lead to, so every further byte leaves the state as it is."""
        closing = self._shift((state & self.stay[SLASH]))
        return ~np.any((state & self.ends) & ~closing, axis=1) & ~np.any(closing & ~self.ends, axis=1)


def canonical_parts(url):
    """Host and path columns of a url column."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_glob(rule: str) -> str:
    return f"*.{rule}**"


def _judge(rules: tuple[tuple[str, str], ...], default: str):
    def judge(batches):
        automaton = Rules([rule_glob(rule) for _, rule in rules]) if rules else None
        order = sorted(range(len(rules)), key=lambda i: -len(rules[i][1]))
        names = np.array([rules[i][1] for i in order] + [None], dtype=object)
        verdicts = np.array([rules[i][0] for i in order] + [default], dtype=object)
        for batch in batches:
            if automaton:
                fits = automaton.fitting(*text_bytes(batch["canonical"]))[:, order]
                fits = np.column_stack((fits, np.ones(len(fits), dtype=bool)))
                best = np.argmax(fits, axis=1)
            else:
                best = np.zeros(len(batch), dtype=int)
            yield pa.record_batch([batch["page_id"], batch["host"], batch["path"], pa.array(names[best], pa.string()),
                                   pa.array(verdicts[best], pa.string())],
                                  names=["page_id", "host", "path", "rule", "verdict"])
    return judge


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every page; ``rules`` are (verdict, ``host/path``)."""
    ship(pages.sparkSession)
    host, path = canonical_parts(F.col("url"))
    parts = pages.select("page_id", F.col("url").cast("string").alias("url")) \
        .select("page_id", host.alias("host"), path.alias("path"))
    parts = parts.withColumn("canonical", F.concat(F.lit("."), "host", "path"))
    kind = dict(parts.dtypes)["page_id"]
    return parts.mapInArrow(_judge(tuple(map(tuple, rules)), default),
                            f"page_id {kind}, host string, path string, rule string, verdict string")
