"""Decontamination, top-k, licences, URL rules, shards and languages."""

import itertools
import os
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import decontaminate, language, licenses, queries, sharding, top_k, url_filter
from shelfcast.llm.words import text_bytes
from shelfcast.session import shared_path

from ..compare import connect, differences
from .tables import ID_TEXT, awkward_documents, prose

ROWS = awkward_documents()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, sf_dir, name):
    assert differences(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLE[name]) == []


def test_leaks_with_replaced_words_are_found(spark):
    rng = random.Random(8)
    items = [(i, prose(rng, 30, 5000)) for i in range(12)] + [(20, "five words make one item"), (21, "too short"), (22, None)]
    docs = []
    for i in range(12):
        passage = items[i][1].split()
        for at in rng.sample(range(30), i // 3):
            passage[at] = "other"
        docs.append((100 + i, f"{prose(rng, 50, 5000)} {' '.join(passage)}, {prose(rng, 50, 5000)}"))
    clean = [(200 + i, prose(rng, 150, 5000)) for i in range(30)]
    short = [(300, f"{prose(rng, 9)} Five words, make one ITEM! {prose(rng, 9)}"), (301, "five words make no item"), (302, "too short")]
    extra = [(None, items[3][1]), (400, None), (401, ""), (100, docs[0][1])]
    table = spark.createDataFrame(docs + clean + short + extra, ID_TEXT).withColumn("key", F.lit("x")).withColumn("item_id", F.lit(1))
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("seeds", F.lit(1))
    found = decontaminate.contaminated(table, benchmark).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in found) == sorted(
        [(str(100 + i), i) for i in range(12)] + [("300", 20), ("302", 21), ("None", 3)])
    left = decontaminate.without_leaks(table, benchmark)
    assert left.columns == table.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted([i for i, _ in clean] + [301, 400, 401])


def test_short_items_are_found_by_rules_of_their_length(spark):
    """Every placement of one replaced word from 6 tokens on, at any place of a document; fewer tokens unchanged or alone."""
    rng = random.Random(12)
    items, docs, want = [], [], set()
    for n in range(1, 15):
        words = [f"t{n}x{j}" for j in range(n)]
        items.append((n, " ".join(words)))
        for j in range(n):
            changed = " ".join(w if i != j else "other" for i, w in enumerate(words))
            for place, text in enumerate((f"{changed} {prose(rng, 20)}", f"{prose(rng, 20)} {changed}", changed)):
                docs.append((1000 * n + 10 * j + place, text))
                if n >= 6:
                    want.add((docs[-1][0], n))
        docs += [(1000 * n + 500, f"{prose(rng, 9)} {' '.join(words)} {prose(rng, 9)}"), (1000 * n + 501, " ".join(words))]
        want |= {(1000 * n + 501, n)} | ({(1000 * n + 500, n)} if n >= 5 else set())
    two = [(90_000 + n, " ".join(w if i not in (1, n - 2) else "other" for i, w in enumerate(f"t{n}x{j}" for j in range(n)))) for n in range(6, 11)]
    table, benchmark = spark.createDataFrame(docs + two, ID_TEXT), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(table, benchmark).collect()} == want
    asked = spark.createDataFrame([(1, "what is the capital city of france")], "item_id long, text string")
    said = spark.createDataFrame([(1, "tell me what is the main city of france today"), (2, "what is the main town of france")], ID_TEXT)
    assert [r.doc_id for r in decontaminate.contaminated(said, asked).collect()] == [1]


def test_leaks_of_awkward_rows(spark):
    item = prose(random.Random(77), 30, 9000)
    rows = [*ROWS, (None, item), (None, f"x {item}"), (80, item), (80, item), (80, f"{item} more"), (81, "y " * 50_000 + item)]
    table = spark.createDataFrame(rows, ID_TEXT).withColumns({name: F.lit(1) for name in ("key", "begin", "tokens", "seeds", "item_id")})
    benchmark = spark.createDataFrame([(1, item), (None, item), (2, None), (3, ""), (1, item)], "item_id long, text string")
    found = decontaminate.contaminated(table, benchmark).collect()
    assert sorted((str(r.doc_id), str(r.item_id), r.matched, r.first_token) for r in found) == sorted(
        (i, item_id, 30, first) for item_id in ("1", "None")
        for i, first in (("None", 0), ("None", 1), ("80", 0), ("80", 0), ("81", 50_000)))  # two different texts of doc 80


def test_time_on_one_repeated_word_grows_with_its_length(spark):
    benchmark = spark.createDataFrame([(1, "word " * 30)], "item_id long, text string")

    def seconds(n: int) -> float:
        table = spark.createDataFrame([(1, "word " * n)], ID_TEXT)
        begin = time.perf_counter()
        assert [r.matched for r in decontaminate.contaminated(table, benchmark).collect()] == [30]
        return time.perf_counter() - begin

    seconds(100)
    assert seconds(40_000) < 2 * 5 * seconds(8_000)


def test_best_stretch():
    assert decontaminate.best_stretch(np.array([0, 1, 1, 1, 0, 1, 1, 1, 0, 0], dtype=bool)) == (1, 8, 6)
    assert decontaminate.best_stretch(np.zeros(5, dtype=bool))[2] == 0


def spared(equal: np.ndarray) -> np.ndarray:
    """Rows of equal (1) and replaced (0) tokens in which some mask meets equal tokens alone."""
    out = np.zeros(len(equal), dtype=bool)
    for mask in decontaminate.MASKS:
        used = [j for j, c in enumerate(mask) if c == "1"]
        for at in range(equal.shape[1] - len(mask) + 1):
            out |= equal[:, [at + j for j in used]].all(axis=1)
    return out


@pytest.mark.parametrize("n", range(10, 16))
def test_every_accepted_placement_in_a_short_item_has_a_seed(n):
    equal = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1 == 1
    equal = equal[equal.sum(axis=1) >= decontaminate.MATCHED]
    found = [decontaminate.best_stretch(e) for e in equal]
    taken = [m >= decontaminate.MATCHED and m >= decontaminate.IDENTITY * (b - a) for a, b, m in found]
    assert any(taken) and spared(equal[taken]).all()


@pytest.mark.parametrize("n", range(12, 29))
def test_every_accepted_stretch_has_a_seed(n):
    """A stretch of highest score has no beginning and no end that scores 0 or less, so three equal tokens at both."""
    for replaced in range(1, min(n // 4, n - decontaminate.MATCHED) + 1):
        at = np.array(list(itertools.combinations(range(3, n - 3), replaced)))
        equal = np.ones((len(at), n), dtype=bool)
        equal[np.arange(len(at))[:, None], at] = False
        score = np.where(equal, 1, -2)
        fits = (np.cumsum(score, axis=1) > 0).all(axis=1) & (np.cumsum(score[:, ::-1], axis=1) > 0).all(axis=1)
        assert spared(equal[fits]).all()


def test_longer_stretches_without_a_seed_have_too_many_replaced_words():
    """The least replaced words that spare no seed, by length; longer stretches fall into parts of 29 to 57 tokens."""
    span = max(map(len, decontaminate.MASKS))
    last = np.arange(1 << span)
    seed = np.any([(last & int(m, 2)) == int(m, 2) for m in decontaminate.MASKS], axis=0)
    least = np.where(last == 0, 0, 1000)
    for n in range(1, 58):
        after = np.full(1 << span, 1000)
        for equal in (0, 1):
            np.minimum.at(after, ((last << 1) | equal) & ((1 << span) - 1), least + 1 - equal)
        least = np.where(seed, 1000, after)
        assert n < 29 or least.min() > (1 - decontaminate.IDENTITY) * n


def test_short_items_with_replaced_words_are_found(spark):
    rng = random.Random(21)
    places = {10: (), 11: (10,), 12: (5,), 13: (3, 6, 9), 15: (3, 7, 11), 20: (3, 7, 11, 15), 28: (3, 7, 11, 15, 19, 23)}
    items = [(n, prose(rng, n, 5000)) for n in places]
    docs = []
    for n, passage in items:
        copy = ["other" if i in places[n] else w for i, w in enumerate(passage.split())]
        docs.append((100 + n, f"{prose(rng, 40, 5000)} {' '.join(copy)} {prose(rng, 40, 5000)}"))
    found = decontaminate.contaminated(spark.createDataFrame(docs, ID_TEXT), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id, r.matched) for r in found.collect()) == [
        (100 + n, n, n - len(gone)) for n, gone in places.items()]


def test_decontamination_on_the_given_tables(spark, sf_dir):
    got = {(r.doc_id, r.item_id) for r in queries.op1_decontamination(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    assert got == {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], ID_TEXT)
    items = spark.createDataFrame([(1, prose(random.Random(1), 30))], "item_id long, text string")
    assert decontaminate.contaminated(docs, items).count() == 0
    some = spark.createDataFrame([(1, "a b c")], ID_TEXT)
    assert decontaminate.without_leaks(some, items.limit(0)).count() == 1
    assert licenses.scan_licenses(docs).count() == 0
    assert sharding.into_shards(docs, shared_path(spark, "map"))[0].count() == 0
    assert top_k.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert url_filter.judged(spark.createDataFrame([], "page_id long, url string"), queries.URL_RULES).count() == 0
    full = spark.createDataFrame([], ID_TEXT + ", lang string, source string")
    assert language.identify(full).count() == 0


def by_hand(vectors, every, k):
    usable = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in vectors
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in usable:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q)
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("size, round_bytes", [(300, 32 << 20), (60, 64)])
def test_top_k_equals_brute_force(spark, monkeypatch, size, round_bytes):
    monkeypatch.setattr(top_k, "ROUND_BYTES", round_bytes)
    rng = np.random.default_rng(size)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=40) * (5 if i % 9 == 0 else 1), 2)]) for i in range(size)]
    rows += [(1000 + i, rows[3][1]) for i in range(15)]
    rows += [(None, rows[0][1]), (2000, None), (2010, [1.0, None]), (2020, [float("nan")] * 40), (2030, [float("inf")] * 40),
             (2040, [1.0] * 50), (2050, []), (2060, [2.0])]
    got = top_k.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4), 10, 7)
    assert sorted(map(tuple, got.collect())) == by_hand(rows, 10, 7)


def test_top_k_with_repeated_ids_and_large_components(spark):
    rows = [(10, [1e6, -1e6]), (10, [1e6, -1e6]), (11, [2e6, 3.0]), (11, [2e6, 3.0]), (12, [-1e6, 1e6])]
    got = top_k.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 10, 3).collect()
    big, small = 1024 * 10**6, 1024 * 3
    assert sorted(map(tuple, got)) == [(10, 1, 11, big * 2 * big - big * small), (10, 2, 11, big * 2 * big - big * small),
                                       (10, 3, 12, -2 * big * big)]


def test_pruning_drops_candidates_and_keeps_the_best():
    rng = np.random.default_rng(0)
    columns = (rng.normal(size=(64, 1500)) * np.geomspace(400, 1, 64)[:, None]).astype(np.int64)
    best = top_k.Best(np.array([5]), columns[:, 5:6], 10)
    seen = []
    original = np.matmul
    for low in range(0, 1500, 500):
        part = columns[:, low:low + 500]
        best.offer(np.arange(low, low + 500), part, top_k.remaining(part))
        seen.append(best.least[0])
    scores = original(columns[:, 5], columns)
    order = np.lexsort((np.arange(1500), -scores))
    assert best.vec[0].tolist() == [i for i in order.tolist() if i != 5][:10]
    assert seen == sorted(seen)


def test_automaton_equals_regular_expressions():
    rng = random.Random(3)
    for _ in range(60):
        globs = ["".join(rng.choice(["a", "b", ".", "/", "*", "**", "é"]) for _ in range(rng.randint(1, 9)))
                 for _ in range(rng.randint(1, 30))]
        texts = ["".join(rng.choice("abé./") for _ in range(rng.randint(0, 14))) for _ in range(40)]
        fits = url_filter.Rules(globs).fitting(*text_bytes(pa.array(texts)))
        for j, glob in enumerate(globs):
            parts = re.findall(r"\*\*|\*|[^*]", glob)
            want = re.compile("".join(".*" if p == "**" else "[^/]*" if p == "*" else re.escape(p) for p in parts), re.S)
            assert [bool(want.fullmatch(t)) for t in texts] == fits[:, j].tolist(), glob


def test_url_rules(spark):
    urls = {"http://Example.ORG/es/x": ("org/", "block"), "https://example.org/en/12": ("example.org/en/1", "block"),
            "https://a.example.org/en/2?q=/es/": ("org/", "allow"), "https://notexample.org/es/": ("org/", "allow"),
            "ftp://shop.com/fr/": ("com/fr/", "allow"), "ftp://shop.com/frs": (None, "allow"), "http://com/de/#x": ("com/de/", "block"),
            "http://org": (None, "allow"), "http://x.org?a=/": (None, "allow"), "no scheme.org/": (None, "allow"), "": (None, "allow"),
            None: (None, "allow"), "://org/": ("org/", "allow"), "http://evil.net/x.org/": (None, "allow"),
            "http://x.org/" + "long/" * 4000: ("org/", "allow")}
    urls["http://Example.ORG/es/x"] = ("example.org/es/", "block")
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string").withColumn("host", F.lit("mine"))
    got = {r.page_id: r for r in url_filter.judged(pages, queries.URL_RULES).collect()}
    for i, (url, want) in enumerate(urls.items()):
        assert (got[i].rule, got[i].verdict) == want, url
    assert (got[0].host, got[0].path) == ("example.org", "/es/x")
    assert {r.verdict for r in url_filter.judged(pages, (), "block").collect()} == {"block"}


def test_shards_are_nearly_equal_and_positions_gapless(spark, sf_dir):
    rows = queries.op7_sharding(spark, sf_dir).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    load = [0] * 8
    places = [[] for _ in range(8)]
    for r in rows:
        assert r["size"] == len(docs[r.doc_id].encode()) + 1
        load[r.shard] += r["size"]
        places[r.shard].append(r.slot)
    assert len(rows) == len(docs)
    assert all(sorted(p) == list(range(len(p))) for p in places)
    assert max(load) - min(load) < 0.02 * sum(load) / 8


def test_editing_a_slot_map_moves_no_more_than_it_must():
    rng = random.Random(6)
    sizes = [rng.randint(0, 5000) for _ in range(sharding.SLOTS)]
    first = sharding.SlotMap.fresh(8).edited(sizes)
    same, more, fewer = first.edited(sizes), first.edited(sizes, 9), first.edited(sizes, 7)
    assert (first.version, same.version) == (2, 3) and same.shard_of == first.shard_of
    moved = [slot for slot in range(sharding.SLOTS) if more.shard_of[slot] != first.shard_of[slot]]
    assert sum(sizes[slot] for slot in moved if more.shard_of[slot] != 8) < 0.01 * sum(sizes)
    assert sum(sizes[s] for s in moved) < 1.02 * sum(sizes) / 9
    assert max(fewer.shard_of) == 6
    for plan in (first, more, fewer):
        load = [sum(s for s, k in zip(sizes, plan.shard_of) if k == shard) for shard in range(plan.shards)]
        assert max(load) - min(load) < 0.01 * sum(load) / plan.shards


def test_shards_of_awkward_rows(spark):
    docs = spark.createDataFrame([(*r, 9) for r in ROWS], ID_TEXT + ", shard int")
    placed, plan = sharding.into_shards(docs, shared_path(spark, "map"), 3)
    rows = placed.collect()
    assert len(rows) == len(ROWS) and {r.version for r in rows} == {plan.version}
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in ROWS)
    for shard in range(3):
        places = sorted(r.slot for r in rows if r.shard == shard)
        assert places == list(range(len(places)))
    assert plan.rows(spark).count() == sharding.SLOTS


def test_a_stored_slot_map_is_edited_twice(spark):
    path = shared_path(spark, "map")
    assert sharding.stored_map(spark, path) is None
    rng = random.Random(3)
    rows = [(i, "x" * rng.randrange(2000)) for i in range(3000)]

    def placed(count: int, shards: int):
        table, plan = sharding.into_shards(spark.createDataFrame(rows[:count], ID_TEXT), path, shards)
        found = {r.doc_id: (r.shard, r.size, r.vslot) for r in table.collect()}
        load = [sum(size for shard, size, _ in found.values() if shard == k) for k in range(shards)]
        assert len(found) == count and max(load) - min(load) < 0.02 * sum(load)
        assert sharding.stored_map(spark, path) == plan
        assert all(plan.shard_of[vslot] == shard for shard, _, vslot in found.values())
        return plan, found

    first, before = placed(2000, 8)
    second, after = placed(3000, 8)
    third, grown = placed(3000, 9)
    assert [plan.version for plan in (first, second, third)] == [2, 3, 4]
    moved = sum(size for i, (shard, size, _) in grown.items() if after[i][0] != shard)
    assert moved < 1.1 * sum(size for _, size, _ in after.values()) / 9
    # What the first map placed is moved only as far as today's sizes ask for.
    assert sum(before[i][0] != after[i][0] for i in before) < 0.2 * len(before)
    spark.createDataFrame([(0, 0, 5)], "vslot int, shard int, version int").write.parquet(f"{path}/part")
    os.makedirs(f"{path.removeprefix('file://')}/v9")  # a writer that died
    assert sharding.stored_map(spark, path) == third


def test_licences_on_held_out_paragraphs():
    rng = np.random.default_rng(99)
    plain = [prose(random.Random(i), 30) for i in range(300)]
    model, features = licenses.fit(plain[:150]), licenses.Features()
    families = list(licenses.TEMPLATES)
    texts, labels = [], []
    for number, family in enumerate(families):
        for template in licenses.TEMPLATES[family]:
            for _ in range(10):
                texts.append(licenses.altered(template, plain[200].split(), rng))
                labels.append(number)
    texts += plain[150:]
    labels += [len(families)] * 150
    found = licenses.units(*text_bytes(pa.array(texts)))
    unit, feature = features.occurrences(found)
    chance = model.probabilities(unit, feature, len(found.low))[:, :-1]
    guess = np.where(chance.max(axis=1) >= model.threshold, chance.argmax(axis=1), len(families))
    truth = np.array(labels)[found.document]
    assert (guess == truth)[truth < len(families)].mean() > 0.93
    assert (guess == truth)[truth == len(families)].mean() > 0.99


def test_licence_scan_of_awkward_rows(spark):
    long = " ".join(["filler"] * 500 + ["Licensed under the Apache License, Version 2.0."] + ["more"] * 500)
    rows = [(1, "text\nReleased under the MIT License.\n\nend"), (2, long), (3, None), (4, ""), (None, "Licensed under CC BY-NC 4.0."),
            (1, "text\nReleased under the MIT License.\n\nend"), (5, "a driving licence was renewed by the public library")]
    got = licenses.scan_licenses(spark.createDataFrame(rows, ID_TEXT).withColumn("family", F.lit("x"))).collect()
    assert sorted((str(r.doc_id), r.paragraph, r.family, r.confirmed) for r in got) == [
        ("1", 1, "mit", True), ("1", 1, "mit", True), ("2", 0, "apache", True), ("None", 0, "cc-by-nc", True)]


def test_a_long_line_gives_a_row_for_each_licence_it_states(spark):
    mit, apache, gpl = (licenses.TEMPLATES[f][0] for f in ("mit", "apache", "gpl"))
    rows = [(1, " ".join(["filler"] * 300 + [apache] + ["more"] * 300 + [mit] + ["more"] * 200 + [apache] + ["end"] * 50))]
    rows += [(100 + n, " ".join(["filler"] * n + [gpl] + ["more"] * 200)) for n in range(80, 121)]
    got = licenses.scan_licenses(spark.createDataFrame(rows, ID_TEXT)).collect()
    assert sorted((r.doc_id, r.paragraph, r.family, r.confirmed) for r in got) == [
        (1, 0, "apache", True), (1, 0, "mit", True), *((100 + n, 0, "gpl", True) for n in range(80, 121))]


def test_all_rights_reserved_is_a_statement_of_the_given_table(spark, sf_dir):
    got = {(r.doc_id, r.paragraph): (r.family, r.confirmed) for r in queries.op3_license_scan(spark, sf_dir).collect()}
    signs = {"Apache License": "apache", "MIT License": "mit", "GNU General": "gpl", "CC BY-NC": "cc-by-nc",
             "All rights reserved.": "proprietary"}
    want = {(r.doc_id, i): (family, True) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
            for i, line in enumerate(r.text.split("\n")) for sign, family in signs.items() if sign in line}
    assert "proprietary" in {family for family, _ in want.values()}
    assert got == want


def test_languages_of_the_given_table(spark, sf_dir):
    rows = queries.op8_language_id(spark, sf_dir).collect()
    declared = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert all(r.keep for r in rows) and len(rows) == len(declared)
    assert np.mean([declared[r.doc_id] == r.language for r in rows]) > 0.99


def test_text_outweighs_a_wrong_declaration_and_evidence_adds_up(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    swapped = docs.withColumn("lang", F.when(F.col("doc_id") % 10 == 0, F.lit("de")).when(F.col("doc_id") % 10 == 1, None)
                              .otherwise(F.col("lang"))).withColumn("source", F.concat("source", F.lit(".example.fr")))
    got = {r.doc_id: r.language for r in language.identify(swapped).select("doc.doc_id", "language").collect()}
    changed = [i for i in truth if i % 10 < 2]
    assert np.mean([got[i] == truth[i] for i in changed]) > 0.95


def test_language_of_awkward_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = [(901, None, "en", "src1"), (902, "", None, None), (903, "12345 !!! ###", "fr", "src2"), (None, "the of and that is", None, None),
           (904, "zqxj kvwq xzqj wqzx qjxz kqzw vxqz" * 20, None, None), (905, "die der und ist nicht", "DE-at", "x.de"), (901, None, "en", "src1")]
    table = docs.union(spark.createDataFrame(odd, docs.schema)).withColumn("language", F.lit("mine")).withColumn("prior", F.lit(1))
    got = language.identify(table)
    rows = {r.doc.doc_id: r for r in got.collect()}
    assert got.count() == docs.count() + len(odd)
    assert [(rows[i].language, rows[i].keep) for i in (901, 902, 903, 904)] == [("und", False)] * 4
    assert rows[None].language == "en" and rows[905].language == "de" and rows[905].doc.language == "mine"
    undeclared = language.identify(table.withColumn("lang", F.lit(None).cast("string")))
    assert {r.language for r in undeclared.collect()} == {"und"}


GREEK = "η γλώσσα και ο τόπος της είναι εδώ με τα παλιά της λόγια και τις νέες λέξεις που δεν τις ξέρει κανείς "


@pytest.mark.parametrize("size", [64, 2])
def test_a_language_of_half_a_percent_has_its_own_model(spark, sf_dir, monkeypatch, size):
    monkeypatch.setattr(language, "ROUND", size)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    rare = [(901, GREEK * 3, "el", "src1"), (902, GREEK[20:], None, None), (903, "zqxj kvwq xzqj wqzx " * 20, "xx", "src2")]
    table = docs.union(spark.createDataFrame(rare, docs.schema))
    assert docs.filter("lang = 'el'").count() + 1 <= 0.005 * docs.count()
    got = {r.doc_id: r for r in language.identify(table).select("doc.doc_id", "language", "keep").collect()}
    assert [(got[i].language, got[i].keep) for i in (901, 902, 903)] == [("el", True), ("el", True), ("xx", True)]
    declared = {r.doc_id: r.lang for r in docs.collect()}
    assert np.mean([declared[i] == got[i].language for i in declared]) > 0.99


def test_trigram_counts_do_not_depend_on_how_many_languages_a_task_holds():
    rng = random.Random(12)
    codes = [f"l{chr(97 + i)}" for i in range(9)]
    batch = pa.record_batch([pa.array([prose(rng, 20) for _ in range(60)]), pa.array([rng.choice(codes) for _ in range(60)])],
                            names=["text", "code"])
    sums = []
    for most in (1, 4, 64):
        total = np.zeros((9, 1 << language.SLOT_BITS), dtype=np.uint64)
        for out in language._count(tuple(codes), most)([batch, batch]):
            total[out["language"][0].as_py()] += language.unsqueeze(out["counts"][0].as_py())
        sums.append(total)
    assert (sums[0] == sums[2]).all() and (sums[1] == sums[2]).all() and sums[0].sum(axis=1).all()


def test_markup_and_addresses_of_pages_count(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = language.identify_pages(pages).select("page.page_id", "language", "keep").collect()
    assert len(rows) == pages.count() and {"page_id", "language", "keep"} == set(rows[0].asDict())
    stated = {r.page_id: r.code for r in pages.select("page_id", language.declared_code(language.markup_language(F.col("html"))).alias("code")).collect()}
    both = [(stated[r.page_id], r.language) for r in rows if stated[r.page_id]]
    assert len(both) > 10 and np.mean([a == b for a, b in both]) > 0.9


def test_only_the_markup_or_only_the_address_decides(spark):
    """Words that two languages share alike: what the page declares, or where it lies, tips the balance."""
    rng = random.Random(4)
    own = {"fr": ["bonjour", "maison", "fromage", "jamais"], "de": ["guten", "haus", "niemals", "woche"]}
    shared = ["radio", "hotel", "taxi", "museum", "piano", "sofa"]

    def words(code: str | None, n: int) -> str:
        return " ".join(rng.choice(shared + (own[code] if code else [])) for _ in range(n))

    rows = [(i, f"https://h{i % 7}.example.com/{i}", f'<html lang="{code}"><script>var guten = "guten guten"</script><p>{words(code, 40)}</p></html>')
            for i, code in enumerate(["fr", "de"] * 60)]
    text = " ".join(shared)
    rows += [(900, "https://one.example.com/", f"<html lang='fr'><p>{text}</p></html>"),
             (901, "https://two.example.com/", f'<HTML class=x lang=de-AT><p>{text}</p></html>'),
             (902, "http://user@three.example.fr:80/x", f"<p>{text}</p>"), (903, "https://four.example.de", f"<p>{text}</p>"),
             (904, "https://five.example.com", f'<head><meta http-equiv="Content-Language" content="fr"></head>{text}'),
             (905, None, None), (906, "no address", "<p></p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("language", F.lit("x"))
    got = {r.page_id: r for r in language.identify_pages(pages).select("page.page_id", "language", "keep").collect()}
    assert [got[i].language for i in range(900, 905)] == ["fr", "de", "fr", "de", "fr"]
    assert not got[905].keep and not got[906].keep and len(got) == len(rows)
    assert all(got[i].language == ("fr", "de")[i % 2] for i in range(120))
