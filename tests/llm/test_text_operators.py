"""Substring dedup, n-gram join, SentencePiece, token files and the pipeline against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import decontaminate, jaccard_join, pieces, queries, range_coder, segments, substring_dedup, token_files
from shelfcast.session import shared_path
from shelfcast.llm.words import shingle_sets, split_words, text_bytes

from .tables import ID_TEXT, awkward_documents, components_by_hand, prose, removed_by_hand, shingles, words

ROWS = awkward_documents()
UNIQUE = [r for r in {r[0]: r for r in ROWS if r[0] is not None}.values()]


@pytest.fixture(scope="module")
def unique(spark):
    return spark.createDataFrame(UNIQUE, ID_TEXT).repartition(5)


@pytest.fixture(scope="module")
def awkward(spark):
    """All rows, with columns named like the operators' own."""
    rows = [(*r, "chunk", 3, b"pack", r[1]) for r in ROWS]
    return spark.createDataFrame(rows, ID_TEXT + ", chunk string, n_words int, pack binary, kept_text string").repartition(4)


def test_words_and_shingles_are_those_of_a_regular_expression():
    texts = [t for _, t in ROWS]
    data, offsets = text_bytes(pa.array(texts))
    found = split_words(data, offsets)
    assert [data[a:b].tobytes() for a, b in zip(found.starts, found.ends)] == [w for t in texts for w in words(t)]
    _, ends = shingle_sets(split_words(*text_bytes(pa.array([(t or "").lower() for t in texts]))))
    assert np.diff(ends).tolist() == [len(shingles((t or "").lower())) for t in texts]


def test_substring_dedup_equals_brute_force(unique):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in substring_dedup.digests(substring_dedup.remove_repeats(unique)).collect()}
    assert got == removed_by_hand(UNIQUE)


def test_substring_dedup_with_awkward_rows(awkward):
    kept = substring_dedup.remove_repeats(awkward).collect()
    assert len(kept) == len(ROWS)
    assert sorted((str(r.rows.doc_id), r.rows.text or "", r.rows.chunk) for r in kept) == \
        sorted((str(i), t or "", "chunk") for i, t in ROWS)
    late = [r for r in kept if r.rows.doc_id is None and r.n_words == 120]
    assert [r.n_removed for r in late] == [120]
    short = substring_dedup.shortened(awkward)
    assert short.columns == awkward.columns and short.count() == len(ROWS)
    same = {r.doc_id: r.text for r in short.collect()}
    assert same[5] == "ONE two  three" and same[1] is None


def test_jaccard_join_equals_brute_force(unique):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_components(unique).collect()}
    label = components_by_hand(UNIQUE)
    assert got == {i: (len(shingles(t)), label[i]) for i, t in UNIQUE}


def test_jaccard_join_with_awkward_rows(awkward):
    rows = jaccard_join.similar_components(awkward).collect()
    assert len(rows) == len(ROWS)
    label = components_by_hand([r for r in ROWS if r[0] is not None])
    for r in rows:
        if r.doc_id is not None:
            assert r.component_id == label[r.doc_id]
    assert sorted(str(r.component_id) for r in rows if r.doc_id is None) == sorted(["9", "None", "None", "None"])
    kept = jaccard_join.first_of_each(awkward)
    assert kept.columns == awkward.columns
    assert sorted(str(i) for i, in kept.select("doc_id").collect()) == sorted(
        map(str, [1, 2, 3, 4, 9, *range(20, 26), 30, 40, 40, 40, -7, 41, 50, 51, 52, None, None, None]))


@pytest.mark.parametrize("edits", [1, 3])
def test_jaccard_join_of_one_large_group_of_near_copies(spark, edits):
    rng = random.Random(edits)
    base = prose(rng, 100, 5000).split()
    rows = [(500, " ".join(base))]
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randint(1, edits + 3)):
            copy[rng.randrange(100)] = f"new{rng.random()}"
        rows.append((i, " ".join(copy)))
    got = {r.doc_id: r.component_id
           for r in jaccard_join.similar_components(spark.createDataFrame(rows, ID_TEXT).repartition(6)).collect()}
    assert got == components_by_hand(rows)


@pytest.mark.parametrize("hot, parts", [(2, 3), (5, 8), (1 << 16, 8)])
def test_hot_lists_are_dealt_out_and_lose_no_link(spark, monkeypatch, hot, parts):
    """Near copies of some texts, texts that share half of these, and bridges between groups: every list counts as hot."""
    rng = random.Random(hot)
    rows, bases = [], [prose(rng, 60) for _ in range(4)]
    for base in bases:
        for _ in range(40):
            own = base.split()
            for at in rng.sample(range(60), rng.randrange(0, 4)):
                own[at] = f"e{rng.randrange(9)}"
            rows.append(" ".join(own))
    for _ in range(30):  # parts of two texts, some of them linked with one or none
        first, second = (rng.choice(bases).split() for _ in range(2))
        cut = rng.choice([20, 40, 54, 57])
        rows.append(" ".join([*first[:cut], *second[cut:]]))
    rows = list(enumerate(rows))
    rng.shuffle(rows)
    monkeypatch.setattr(jaccard_join, "HOT_LIST", hot)
    written, store = [], jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda df, name: written.append(name) or store(df, name))
    parts_before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {r.doc_id: r.component_id for r in jaccard_join.similar_components(spark.createDataFrame(rows, ID_TEXT)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts_before)
    assert got == components_by_hand(rows)
    assert ("leaders" in written and "majorities" in written) == (hot < len(rows))


def test_prefixes_of_similar_sets_share_what_is_asked():
    rng = np.random.default_rng(3)
    frequency = rng.integers(0, 50, 1 << jaccard_join.SKETCH_BITS).astype(np.uint32)
    for _ in range(200):
        n = int(rng.integers(1, 80))
        x = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        y = np.unique(np.concatenate((x[rng.random(len(x)) < 0.95], rng.integers(0, 1 << 62, 2).astype(np.uint64))))
        both = len(np.intersect1d(x, y))
        if 100 * both < 80 * (len(x) + len(y) - both):
            continue
        l, tokens, owner = jaccard_join.prefixes(np.concatenate((x, y)), np.array([0, len(x), len(x) + len(y)]), frequency)
        shared = len(np.intersect1d(tokens[owner == 0], tokens[owner == 1]))
        sizes = np.array([len(x)]), np.array([len(y)])
        assert shared >= jaccard_join.needed_in_prefixes(sizes[0], l[:1], sizes[1], l[1:])[0]


TRICKY = ["", " ", "   a  b ", "a" * 300, "ab" * 90, " " * 37, "\n\n x\n", "<s></s>", "<0x0A>", "中文 字符", "▁ a▁ b", "\x00é🙂", None]


def test_sentencepiece_equals_the_library(spark):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(1)
    texts = TRICKY + ["".join(rng.choice("abein th  ▁\n.é中") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "one"), (None, "one"), (7, "one")]
    got = pieces.encode_and_decode(spark.createDataFrame(rows, ID_TEXT)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.doc_id is not None or r.decoded == "one"
    by_id = {r.doc_id: r for r in got if r.doc_id is not None and r.doc_id != 7}
    for i, text in rows:
        if i in by_id:
            want = library.encode(text or "", add_bos=True, add_eos=True)
            assert np.frombuffer(by_id[i].ids, "<u4").tolist() == want
            assert by_id[i].decoded == library.decode(want)


def test_bytes_that_spell_no_character_decode_as_in_the_library():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), pieces.pieces(path)
    rng = random.Random(2)
    for _ in range(200):
        ids = [rng.choice([1, 2, 3, 198, 230, 231, 232, 250, 300, 400, 29871]) for _ in range(rng.randint(1, 8))]
        assert own.decode(np.array(ids), np.array([0, len(ids)]))[0].decode() == library.decode(ids), ids


def test_many_bytes_that_spell_no_character_decode():
    import public_tokenizers

    own = pieces.pieces(public_tokenizers.path("piece_bpe_32k.model"))
    assert own.decode(np.full(20_000, 231), np.array([0, 20_000]))[0].decode() == "\ufffd" * 20_000


def two_that_fool_polynomials(n: int) -> tuple[str, str]:
    """Sequences of two letters whose polynomial hashes modulo 2**64 are equal from 1,024 letters on, for any base."""
    bits = [0]
    while len(bits) < n:
        bits += [1 - b for b in bits]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [64, 1024, 2048])
def test_different_long_words_and_segments_are_told_apart(spark, n):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    rng = random.Random(n)
    first, second = two_that_fool_polynomials(n)
    before, after = prose(rng, 12), prose(rng, 12)
    rows = [(1, f"{before} {first} {after}"), (2, f"{before} {second} {after}"), (3, first), (4, second),
            (5, f"{first} x"), (6, f"{second} x"), (7, f"{first} {second} y"), (8, f"{second} {first} y")]
    table = spark.createDataFrame(rows, ID_TEXT).coalesce(1)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.digests(
        substring_dedup.remove_repeats(table)).collect()} == removed_by_hand(rows)
    label = components_by_hand(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_components(table).collect()} == {
        i: (len(shingles(t)), label[i]) for i, t in rows}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in pieces.encode_and_decode(table).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(dict(rows)[r.doc_id], add_bos=True, add_eos=True)
    byte_level = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in token_files.round_trip(table).collect():
        ids = [*byte_level.encode(dict(rows)[r.doc_id], add_special_tokens=False).ids, 2]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    leaks = decontaminate.contaminated(table, spark.createDataFrame([(1, f"{before} {first} {after}")], "item_id long, text string"))
    assert {r.doc_id: r.matched for r in leaks.collect()}.get(1) == 25


def test_segments_whose_hashes_agree_are_told_apart(monkeypatch):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    batch = text_bytes(pa.array([prose(random.Random(1), 50), prose(random.Random(2), 50)]))
    fresh = pieces.Encoder(pieces.pieces(path)).encode(*batch)[0].tolist()
    whole = segments.byte_hashes
    monkeypatch.setattr(segments, "byte_hashes", lambda data, starts, ends, seed=0: whole(data, starts, ends, seed) % np.uint64(
        3 if seed == 0 else 1 << 63))
    assert pieces.Encoder(pieces.pieces(path)).encode(*batch)[0].tolist() == fresh


def test_a_forgetful_cache_gives_the_same_ids(monkeypatch):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    batches = [text_bytes(pa.array([prose(random.Random(i), 50) for i in range(k, k + 3)])) for k in range(5)]
    fresh = [pieces.Encoder(pieces.pieces(path)).encode(*b)[0].tolist() for b in batches]
    monkeypatch.setattr(segments, "MOST_KEPT", 20)
    own = pieces.Encoder(pieces.pieces(path))
    assert [own.encode(*b)[0].tolist() for b in batches] == fresh


@pytest.mark.parametrize("n, block", [(0, 512), (1, 512), (511, 512), (1025, 512), (9000, 4096)])
def test_range_coder_round_trip(n, block):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 1 << 16, n), rng.integers(0, 3, n), np.full(n, 65535), np.arange(n) % 700):
        blocks = range_coder.encode(ids, block)
        assert range_coder.decode(blocks, n, block).tolist() == ids.tolist()


def test_range_coder_learns_and_notices_damage():
    rng = np.random.default_rng(0)
    ids = np.tile(rng.integers(0, 50_000, 64), 40)
    blocks = range_coder.encode(ids, 2560)
    assert sum(map(len, blocks)) < 0.25 * 2 * len(ids)
    spoilt = bytearray(blocks[0])
    spoilt[40] ^= 1
    with pytest.raises(ValueError):
        range_coder.decode([bytes(spoilt)], len(ids), 2560)


def test_blocks_decode_alone():
    ids = np.random.default_rng(1).integers(0, 900, 1500)
    blocks = range_coder.encode(ids, 512)
    assert range_coder.decode(blocks[1:2], 512, 512).tolist() == ids[512:1024].tolist()


def test_token_files_equal_the_library(spark, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(4)
    texts = TRICKY + ["".join(rng.choice(["a", " ", "\n", ".", "é", "　", "'s", " the", "<|endoftext|>"])
                              for _ in range(rng.randint(0, 40))) for _ in range(500)]
    rows = [(3 * i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    got = sorted(token_files.round_trip(spark.createDataFrame(rows, ID_TEXT).repartition(3)).collect())
    at = 0
    for r, (doc_id, text) in zip(got, sorted(rows), strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert tuple(r) == (doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_token_files_with_awkward_rows(awkward):
    got = token_files.round_trip(awkward).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ROWS)
    spans = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))


def test_token_files_of_one_hot_id_are_spread(spark):
    """A third of the rows without an id, a third with one: no file holds more than a few shares, and all ids come back."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"{prose(random.Random(i), 12)}") for i in range(3000)]
    out = shared_path(spark, "tokens")
    token_files.write_token_files(spark.createDataFrame(rows, ID_TEXT).repartition(6), out)
    back = token_files.read_token_files(spark, out)
    by_part = [r["count"] for r in back.groupBy("part").count().collect()]
    assert sum(by_part) == len(rows) and max(by_part) < 3 * len(rows) / len(by_part) and len(by_part) >= 7
    found = sorted(back.collect(), key=lambda r: r.start)
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1].tolist()]
    assert [r.doc_id for r in found] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], ID_TEXT)
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert jaccard_join.similar_components(empty).count() == 0
    assert jaccard_join.first_of_each(empty).count() == 0
    assert pieces.encode_and_decode(empty).count() == 0
    assert token_files.round_trip(empty).count() == 0


@pytest.mark.parametrize("name", ["op9_substring_dedup", "op10_jaccard_join", "op6_sentencepiece"])
def test_queries_on_the_given_table(spark, sf_dir, name):
    got = {r.doc_id: r for r in queries.QUERIES[name](spark, sf_dir).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert len(got) == len(rows)
    if name == "op9_substring_dedup":
        assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in got.items()} == removed_by_hand(rows)
    elif name == "op10_jaccard_join":
        assert {i: r.component_id for i, r in got.items()} == components_by_hand(rows)
    else:
        import public_tokenizers
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        for i, text in rows:
            ids = library.encode(text, add_bos=True, add_eos=True)
            assert got[i].n_tokens == len(ids)
            assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_pipeline_stage_by_stage(spark, sf_dir):
    import corpus_pipeline
    from shelfcast.llm.graph import stored

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    outputs = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        outputs.append(docs)
        if name != "sentencepiece":
            assert docs.columns == before.columns
        rows = {r.doc_id: r for r in before.collect()}
        if name == "near_duplicates":
            label = components_by_hand([(i, r.text) for i, r in rows.items()])
            assert {r.doc_id for r in docs.collect()} == {i for i, low in label.items() if i == low}
        if name == "substring_dedup":
            want = removed_by_hand([(i, r.text) for i, r in rows.items()])
            for r in docs.collect():
                assert hashlib.sha256(b" ".join(words(r.text))).hexdigest() == want[r.doc_id][2]
                assert r.n_chars == len(r.text)
        if name == "decontamination":
            kept = {r.doc_id for r in docs.collect()}
            assert all((i in kept) == (not any(b in r.text for b in benchmark)) for i, r in rows.items())
    assert outputs[0].count() == 200
    assert corpus_pipeline.run(spark, sf_dir).agg(F.sum("n_tokens")).first() == outputs[-1].agg(F.sum("n_tokens")).first()


def test_pipeline_stages_with_awkward_rows(spark, sf_dir):
    import corpus_pipeline
    from shelfcast.llm.graph import stored

    given = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).selectExpr(
        "doc_id + 1000 AS doc_id", "text", "lang", "source", "n_chars")
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in ROWS], given.schema)
    extra = {name: F.lit(name) for name in ("chunk", "keep", "pack", "rows", "key", "leak", "doc", "kept_text", "ids")}
    docs = given.union(odd).withColumns(extra).repartition(4)
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, columns = stored(stage(spark, docs, sf_dir), name), docs.columns
        assert docs.columns == columns and 0 < docs.count() <= before
        assert {r.keep for r in docs.select("keep").distinct().collect()} == {"keep"}
        before = docs.count()
        if name == "language_id":
            assert docs.where("text IS NULL OR trim(text) = ''").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and last.count() == before
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0, name
