"""Token files: one coding step for an id, few calls of the library for new segments, and the library's ids."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from shelfcast.llm import range_coder, token_files
from shelfcast.llm.words import text_bytes
from tests.llm.tables import prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


class Counting:
    """The library, with the number of texts that it was given."""

    def __init__(self, library):
        self.library, self.texts = library, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.library.encode_batch_fast(texts, **options)


def ids_by_library(library, texts, end_id=2):
    return [i for t in texts for i in (*library.encode(t, add_special_tokens=False).ids, end_id)]


def test_an_id_takes_one_coding_step(monkeypatch):
    """Each id of a section goes through the range coder once, whatever its rank needs of digits."""
    steps, whole = [0], range_coder._Lanes.code_id

    def counted(self, symbol_of, renormalise):
        def count(state):
            steps[0] += state.n
            renormalise(state)
        return whole(self, symbol_of, count)
    monkeypatch.setattr(range_coder._Lanes, "code_id", counted)
    ids = np.random.default_rng(0).integers(0, 40_000, 6000).astype(np.int32)
    section = token_files.write_section([1], np.array([len(ids)]), ids)
    assert steps[0] == len(ids)
    assert token_files.read_section(section)[2].tolist() == ids.tolist()
    assert steps[0] == 2 * len(ids)


def test_new_segments_share_calls_of_the_library():
    texts = ["".join(f" w{i * 2500 + j}x" for j in range(2500)) for i in range(2)]
    own = token_files.Encoder(PATH)
    library, own.library = own.library, Counting(own.library)
    assert own.encode(*text_bytes(pa.array(texts)), 2)[0].tolist() == ids_by_library(library, texts)
    assert own.library.texts <= 5000 / 20


def test_a_stop_after_a_word_makes_no_new_segment():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    own = token_files.Encoder(PATH)
    library, own.library = own.library, Counting(own.library)
    own.encode(*text_bytes(pa.array(["".join(f" {w}" for w in words)])), 2)
    texts = ["".join(f" {w}{stop}" for w in words) for stop in ".,;:!?"]
    before = own.library.texts
    assert own.encode(*text_bytes(pa.array(texts)), 2)[0].tolist() == ids_by_library(library, texts)
    assert own.library.texts - before <= 6


def test_ids_around_stops_and_letters_are_the_library_s():
    rng = random.Random(8)
    parts = ["a", "É", "é", "×", "÷", "ß", "…", "é", " ", " ", "  ", "\n", ".", ",", "!?", "'s", "'", "7", "x.", " the", "<|endoftext|>",
             "endoftext|", "\U0001f600", "ａ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    own = token_files.Encoder(PATH)
    library = own.library
    assert own.encode(*text_bytes(pa.array(texts)), 2)[0].tolist() == ids_by_library(library, texts)


def test_later_calls_find_and_add_segments():
    own = token_files.Encoder(PATH)
    for i in range(6):
        texts = [prose(random.Random(j), 40 + 30 * j) + f" new{i} {i}{i} words" for j in range(i, i + 3)]
        assert own.encode(*text_bytes(pa.array(texts)), 2)[0].tolist() == ids_by_library(own.library, texts)


@pytest.mark.parametrize("n", [1, 2, 2047, 70_000])
def test_sections_come_back_whole_and_damage_is_noticed(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 1 << 16, n), rng.geometric(0.01, n), np.full(n, 65535), np.tile(rng.integers(0, 50_000, 40), n // 40 + 1)[:n]):
        ids = ids.astype(np.int32)
        counts = np.array([n // 2, n - n // 2])
        section = token_files.write_section([None, 5], counts, ids)
        doc_ids, sizes, back = token_files.read_section(section)
        assert (doc_ids, sizes.tolist(), back.tolist()) == ([None, 5], counts.tolist(), ids.tolist())
        for place in (len(section) // 2, len(section) - len(section) // 4):
            spoilt = bytearray(section)
            spoilt[place] ^= 64
            with pytest.raises(ValueError):
                read = token_files.read_section(bytes(spoilt))[2]
                # A bit after the last one that tells an id from others changes nothing.
                if read.tolist() == ids.tolist():
                    raise ValueError("no difference")


def test_shares_and_followers():
    share = range_coder.shares(np.array([1 << 40, 1, 0, 7]))
    assert share.sum() == range_coder.TOTAL and share.min() == 1
    assert range_coder.shares(np.ones(1 << 16)).sum() == range_coder.TOTAL
    first = range_coder.followers(np.array([3, 4, 3, 5, 3, 5, 9], dtype=np.uint16))
    assert (first[3], first[4], first[5], first[9]) == (5, 3, first[5], 0)


def test_a_section_is_smaller_than_by_order_0_alone():
    rng = np.random.default_rng(5)
    follows = rng.integers(0, 3000, 3000)
    ids = np.zeros(60_000, dtype=np.int32)
    for i in range(1, len(ids)):
        ids[i] = follows[ids[i - 1]] if rng.random() < 0.7 else rng.integers(0, 3000)
    section = token_files.write_section([1], np.array([len(ids)]), ids)
    share = np.bincount(ids) / len(ids)
    share = share[share > 0]
    assert len(section) * 8 < 0.75 * len(ids) * -(share * np.log2(share)).sum()
