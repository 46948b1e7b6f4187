"""Personal data, importance resampling and hard negatives against plain versions, and on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import hard_negatives, personal_data, queries, resampling

from .tables import ID_TEXT, awkward_documents, prose

ROWS = awkward_documents()

# Personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def with_check_digit(rng: random.Random, start: str, size: int) -> str:
    body = start + "".join(rng.choice("0123456789") for _ in range(size - 1 - len(start)))
    return next(body + c for c in "0123456789" if luhn(body + c))


def base_by_hand(text: str | None) -> list[str]:
    found = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or "", re.ASCII):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                found.append((m.start(), number, f"{kind}:{m.start()}:{m.end()}"))
    return [span for _, _, span in sorted(found)]


def checked(rows, texts):
    """Base digests and counts equal those by hand; base spans are among all spans."""
    by_id = {r.doc_id: r for r in rows}
    assert len(by_id) == len(texts)
    for doc_id, text in texts.items():
        base, row = base_by_hand(text), by_id[doc_id]
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), (doc_id, text, row.spans, base)
        kinds = Counter(span.split(":")[0] for span in base)
        assert [row[f"n_{kind}"] for kind in PATTERNS] == [kinds[kind] for kind in PATTERNS]
        assert set(base) <= set(filter(None, row.spans.split(",")))


def test_base_spans_of_random_texts_equal_those_by_hand(spark):
    rng = random.Random(31)
    pieces = ["@", ".", "-", " ", "+", "(", ")", "%", "_", "a", "b.c", "x@y.zz", "é", "🙂", "\n", "\u0001", "\u0002", "1", "12", "255", "256",
              "0", "007", "1.2.3.4", "300.1.2.3", "4111111111111111", "4111 1111-1111 1111", "+1 (743) 555-3824", "+49 30 901820", "$0", "\\"]
    texts = {i: "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 24))) for i in range(3000)}
    rows = personal_data.digests(personal_data.personal_data(spark.createDataFrame(list(texts.items()), ID_TEXT))).collect()
    checked(rows, texts)


def test_personal_data_of_the_given_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    checked(queries.op11_personal_data(spark, sf_dir).collect(), texts)


def test_the_classifier_adds_what_the_base_patterns_miss_and_leaves_the_rest(spark):
    rng = random.Random(4)
    docs, hidden, clean = [], {}, []
    for i in range(300):
        card, other = with_check_digit(rng, "4", 16), with_check_digit(rng, "52", 16)
        phone = f"+1 ({rng.randrange(201, 999)}) 555-{rng.randrange(1000, 9999)}"
        ip = ".".join(str(rng.randrange(11, 200)) for _ in range(4))
        docs.append((i, f"{prose(rng, 8)} {card} {prose(rng, 6)} {phone} {prose(rng, 6)} {ip}, a{i}@mail.example.com {prose(rng, 5)}"))
        if i < 40:
            docs.append((1000 + i, f"{prose(rng, 8)} {card} {other} {prose(rng, 8)}"))
            hidden[1000 + i] = ["card", "card"]
            docs.append((2000 + i, f"{prose(rng, 8)} call {phone} {ip} {prose(rng, 8)}"))
            hidden[2000 + i] = ["phone", "ip"]
            failing = card[:-1] + str((int(card[-1]) + 1) % 10)
            docs.append((3000 + i, f"{prose(rng, 8)} {failing} {prose(rng, 4)} 999.888.1.2 {prose(rng, 8)} 12 {i}"))
            clean.append(3000 + i)
    rows = {r.doc_id: [s.kind for s in r.spans] for r in
            personal_data.personal_data(spark.createDataFrame(docs, ID_TEXT)).collect()}
    assert all(rows[i] == [] for i in clean)
    found = sum(rows[i] == kinds for i, kinds in hidden.items())
    assert found >= 0.9 * len(hidden), (found, [(i, rows[i]) for i in hidden if rows[i] != hidden[i]][:5])


def test_personal_data_on_awkward_rows(spark):
    def long(n: int) -> str:
        return f"{'7' * n} {'a.' * n} {'x@y' * n} +1{' ' * n}{' 1.2.3.4 ' * 300}"

    rows = [*ROWS, (60, long(1_000)), (63, long(300_000)), (61, "a@b.de\u0001c@d.fr"), (62, "\u0001\u0002")]
    table = spark.createDataFrame(rows, ID_TEXT).withColumns({"spans": F.lit(1), "kind": F.lit("x"), "start": F.lit(2)})
    out = personal_data.digests(personal_data.personal_data(table)).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    assert by_id[60].n_ip == by_id[63].n_ip == 300
    assert by_id[60].base_sha256 == hashlib.sha256(",".join(base_by_hand(long(1_000))).encode()).hexdigest()
    assert by_id[61].spans == "email:0:6,email:7:13"
    assert by_id[1].spans == "" and by_id[1].n_email == 0 and by_id[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert personal_data.digests(personal_data.personal_data(spark.createDataFrame([], ID_TEXT))).collect() == []


def test_personal_data_runs_no_python(spark, sf_dir):
    plan = queries.op11_personal_data(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# Importance resampling

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def features_by_hand(text: str | None) -> list[int]:
    words = WORD.findall((text or "").encode().translate(LOWER))
    return [zlib.crc32(f) % 10_000 for f in (*words, *(b" ".join(pair) for pair in zip(words, words[1:])))]


def resampled_by_hand(docs, target):
    s, t = (Counter(b for text in texts for b in features_by_hand(text)) for texts in ([text for _, text in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        own = features_by_hand(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in own]
        weight = sum(gains) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(own), weight, score, (len(own) + 1) // 2 >= 20))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = len(order) * 25 // 100
    return rows, {r[0]: i + 1 for i, r in enumerate(order[:drawn])}, drawn


def test_features_of_lines_and_across_them_are_those_of_the_text():
    rng = random.Random(9)
    pieces = ["ab", "C", "é", "\n", "\n\n", " ", ".", "9", "z" * 70, "Ünï", "\x00", "🙂", "w" * 64, "x" * 65]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 60))) for _ in range(400)] + ["", "\n", "a\nb", "a"]

    def flat(parts):
        raw = [p.encode() for p in parts]
        return np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw])))

    across, cuts, words = resampling.crossings(*flat(texts))
    for i, text in enumerate(texts):
        values, ends = resampling.line_features(*flat(text.split("\n")))
        assert len(ends) == len(text.split("\n")) + 1
        assert sorted([*values.tolist(), *across[cuts[i]:cuts[i + 1]].tolist()]) == sorted(features_by_hand(text)), text
        assert words[i] == (len(features_by_hand(text)) + 1) // 2


def test_resampling_equals_the_plain_version_on_awkward_rows(spark):
    target = [prose(random.Random(2), 40), None, "", "one two\nthree"]
    extra = [(70 + i, f"{prose(random.Random(i), 30)}\nthe same line here\n{prose(random.Random(i), 5)}") for i in range(40)]
    docs = [*ROWS, *extra]
    table = spark.createDataFrame(docs, ID_TEXT).withColumns({"score": F.lit(1), "row": F.lit(2), "line": F.lit("x"), "gain": F.lit(1)})
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resampling.resampled(table, wanted).collect()
    rows, ranks, drawn = resampled_by_hand(docs, target)
    assert sorted(str(r[:4]) for r in got) == sorted(str(r[:4]) for r in rows)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, drawn + 1))
    assert {r.doc_id: r["rank"] for r in got if r["rank"] and r.doc_id not in (None, 11, 40)} == {
        k: v for k, v in ranks.items() if k not in (None, 11, 40)}
    assert resampling.resampled(table.limit(0), wanted).collect() == []
    nothing = resampling.resampled(table, wanted.limit(0)).collect()
    assert sorted(str(r[:4]) for r in nothing) == sorted(str(r[:4]) for r in resampled_by_hand(docs, [])[0])


# Hard negatives

def mined_by_hand(rows):
    usable = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        own = (label, tuple(math.floor(256 * float(np.float32(x))) for x in vector))
        usable[vec_id] = min(usable.get(vec_id, own), own)

    def score(a, b):
        return sum(x * y for x, y in zip(usable[a][1], usable[b][1]))

    out = []
    for anchor in (i for i in usable if i % 50 == 0):
        others = sorted((-score(anchor, i), i) for i in usable if i != anchor)
        for minus, positive in [o for o in others if usable[o[1]][0] == usable[anchor][0]][:5]:
            fitting = [(i, -m) for m, i in others if usable[i][0] != usable[anchor][0] and 50 * -minus <= 100 * -m <= 95 * -minus]
            out += [(anchor, positive, rank, i, -minus, s) for rank, (i, s) in enumerate(fitting[:3], 1)]
    return sorted(out)


@pytest.mark.parametrize("size", [1, 3, 16])
def test_hard_negatives_equal_the_plain_version_on_awkward_rows(spark, size, monkeypatch):
    # Small clusters, blocks, slices and tiles, so that all of them are many.
    for name, value in (("MEMBERS", 2), ("BLOCK_BYTES", 8 * 3 * size), ("SLICE_BYTES", 8 * 40 * size), ("TILE", 7)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(size)
    centres = rng.normal(size=(4, size))
    rows = [(i * 10, [float(x) for x in (centres[i % 4] + 0.3 * rng.normal(size=size)) * (1 + i % 3)], i % 5) for i in range(160)]
    rows += [(3, None, 1), (4, [None] * size, 1), (5, [float("nan")] * size, 1), (6, [float("inf")] * size, 2), (None, [1.0] * size, 1),
             (8, [1.0] * size, None), (50, rows[5][1], rows[5][2]), (100, [9.0] * size, 0), (150, [0.0] * size, 1), (2050, [0.0] * size, 1),
             (12, [1.0], 1), (13, [], 2), (14, [2.0] * (size + 2), 3), *[(3001 + i, rows[0][1], i % 5) for i in range(30)]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns(
        {"v": F.lit(1), "slice": F.lit(2), "block": F.lit(3), "score": F.lit("x")})
    got = hard_negatives.hard_negatives(table).collect()
    assert sorted(tuple(r) for r in got) == mined_by_hand(rows)
    assert hard_negatives.hard_negatives(table.limit(0)).collect() == []


def test_a_list_is_walked_only_as_far_as_its_bounds_demand():
    rng = np.random.default_rng(1)
    near, far = rng.normal(size=(40, 8)) + 8, rng.normal(size=(4000, 8))
    candidates = np.floor(np.concatenate((far, near)) * 256).astype(np.int64)
    members = np.floor((rng.normal(size=(5, 8)) / 4 + 8) * 256).astype(np.int64)
    shared = hard_negatives.SharedList(candidates, members)
    seen = []
    scores = shared.scores
    shared.scores = lambda of, at: seen.append(len(at)) or scores(of, at)
    ids = np.arange(len(candidates)) + 1
    found = hard_negatives.positives(ids, np.zeros(len(ids), dtype=int), shared, -np.arange(5) - 1, np.zeros(5, dtype=int), 5)
    exact = members @ candidates.T
    for i, best in found:
        assert best.vec.tolist() == ids[np.lexsort((ids, -exact[i]))[:5]].tolist()
    assert sum(seen) < len(candidates) / 2
    place = len(ids) // 2
    assert (exact[:, shared.order[place:]].max(axis=1) <= shared.most(place, np.arange(5))).all()
