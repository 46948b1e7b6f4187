"""Small awkward tables, and plain versions of what the operators compute."""

from __future__ import annotations

import hashlib
import random
import re

ID_TEXT = "doc_id long, text string"
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[bytes]:
    return WORDS.findall((text or "").encode())


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}x{rng.randrange(3)}" for _ in range(n))


def awkward_documents() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and very long texts, ties, repeated rows, near copies and shared passages."""
    rng = random.Random(5)
    base, passage = prose(rng, 120), prose(rng, 40)
    rows: list[tuple[int | None, str | None]] = [(1, None), (2, ""), (3, " \n\t "), (4, "one two three"), (5, "ONE two  three")]
    rows += [(10, base), (11, base), (12, base.upper()), (13, base.replace(" ", "\n", 3)), (11, base)]
    near = base.split()
    near[50] = "changed"
    rows += [(14, " ".join(near)), (9, " ".join(near[:110]))]
    rows += [(20 + i, f"{prose(rng, 15)} {passage} {prose(rng, 15)}") for i in range(6)]
    rows += [(30, passage), (31, f"{passage} {passage}")]
    rows += [(None, base), (None, prose(rng, 60)), (None, prose(rng, 60)), (None, None)]
    rows += [(40, prose(rng, 50)), (40, prose(rng, 50)), (40, None), (-7, prose(rng, 30)), (41, "é中🙂 " * 30)]
    rows += [(50, prose(rng, 20_000, 50_000)), (51, "x" * 30_000), (52, "a b " * 3_000)]
    return rows


def removed_by_hand(rows: list[tuple[int, str | None]], width: int = 20) -> dict[int, tuple[int, int, str]]:
    """doc_id -> words, removed words, sha256 of the rest, for unique ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        own = words(text)
        gone = [False] * len(own)
        for i in range(len(own) - width + 1):
            window = tuple(own[i:i + width])
            if window in seen:
                gone[i:i + width] = [True] * width
            seen.add(window)
        rest = b" ".join(w for w, g in zip(own, gone) if not g)
        out[doc_id] = (len(own), sum(gone), hashlib.sha256(rest).hexdigest())
    return out


LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None) -> set[tuple[bytes, ...]]:
    own = [w.translate(LOWER) for w in words(text)]
    if not own:
        return set()
    return {tuple(own[i:i + 5]) for i in range(len(own) - 4)} if len(own) >= 5 else {tuple(own)}


def components_by_hand(rows: list[tuple[int, str | None]]) -> dict[int, int]:
    """doc_id -> smallest doc_id that links reach; every pair is compared.  Rows with one id are one document."""
    sets = [(doc_id, shingles(text)) for doc_id, text in rows]
    label = {doc_id: doc_id for doc_id, _ in rows}
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i]
             if x and y and 100 * len(x & y) >= 80 * len(x | y)]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label
