"""Personal data in texts: email addresses, IP addresses, payment cards and phone numbers, with built-in functions alone.

Method: weak supervision.  Patterns cut candidates out of every text: the base patterns, and a looser one for what they miss (a
card beside another number, a phone without its plus sign, an address written with "(at)" or "[.]").  Labelers of three kinds vote
on each candidate: regex labelers on its shape, its check and its ends, a gazetteer of endings, issuers and calling codes, context
labelers on the words and numbers around it.  Expectation-maximisation estimates, for each kind of data, how reliable each
labeler is, from the votes on all candidates of the corpus and without any label.  Its posteriors train the span classifier,
a logistic regression on the votes and on what no labeler looks at (length, place in the line, single piece or many).  The
classifier decides on the candidates of the looser pattern; a candidate of a base pattern that passes its check stays.

How it runs.  One pass over the texts, without a shuffle, writes each document's candidates.  Training sees them as counts of
equal vote patterns, a few thousand rows at most (KINDS x sources x 3 to the power of FEATURES), whatever the corpus holds: each step is
one aggregate over that table.  A second pass over the written candidates scores them in place.  So nothing is grouped by
document, source or copy, and a hot one is nothing special.

Defined results.  A null or empty text has no spans: counts 0, empty ``spans``.  Rows without doc_id, and equal rows, are
documents like all others.  Positions are code points, the end exclusive.  Matches are leftmost and do not overlap within a base
kind; base spans of different kinds may overlap, added spans overlap no other.  A match that fails its check is dropped, not
tried again, but the looser pattern sees its pieces.  Texts of any length are searched whole, in time that grows with their
length; only the looser pattern's candidates are compared with each base span of their text.  Empty table: no rows.  Other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.graph import stored

KINDS = ("email", "ip", "card", "phone")
BASE, FAILED, LOOSE = 0, 1, 2
"""Where a candidate comes from: a base pattern that passes its check, one that fails it, the looser pattern."""
LEAST = 0.9
"""Probability from which a candidate of the looser pattern is added."""
CONTEXT_LEFT, CONTEXT_RIGHT = 40, 24
EM_ROUNDS, FIT_ROUNDS = 10, 16
PRIOR_STRENGTH = 20.0
"""Candidates' worth of belief in the labelers before any vote is counted."""
RIDGE = 1.0
MARK, STAND_IN = "\u0001", "\u0002"
"""Marks matches within a text; the stand-in takes its place where a text holds it, one code point for one."""

# The base patterns.  A run of characters is entered at its first one, or where the last match ended, and is
# not given back, so that searching takes time in proportion to the text.
BASE_PATTERNS = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9]++(?:[\x20-][0-9]++)*+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
# The looser pattern, tried in this order: an address with "(at)", an IP with "[.]", a card, a phone.
LOOSE_PATTERN = (
    r"(?<![A-Za-z0-9._%+-])(?:"
    r"[A-Za-z0-9][A-Za-z0-9._%+-]*+\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(](?:dot|DOT|\.)[\])])\x20?[A-Za-z0-9-]++)++"
    r"|[0-9]{1,3}+(?:[\[(]\.[\])][0-9]{1,3}+){3}"
    r"|[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}(?![0-9])|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}(?![0-9])|[0-9]{12,19}(?![0-9])"
    r"|(?:00|\+)[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])"
    r"|(?:\([0-9]{3}\)|[0-9]{3})[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
    r")")
# A plus sign and an opening bracket are no part of the number before them, but the pattern above would not start behind a digit.
LOOSE_PATTERN = LOOSE_PATTERN.replace("(?<![A-Za-z0-9._%+-])(?:", "(?:(?<![A-Za-z0-9._%+-])|(?<=[0-9])(?=\\+))(?:", 1)

# Endings of addresses, first digits of card issuers, calling codes (zones of one and two digits, and
# the two digits that start codes of three), and words that stand beside each kind of data.
ENDINGS = "com|org|net|edu|gov|mil|int|info|biz|io|ai|app|dev|eu|de|fr|es|it|nl|be|ch|at|pl|pt|uk|ie|se|no|dk|fi|us|ca|mx|br|au|nz|jp|cn|in|ru"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|30[0-5]|3[68]|35|6011|64[4-9]|65|62|50|5[6-9]|6[37])"
CALLING = (r"^(?:\+|00)(?:1[\x20.(-]*[2-9]|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
           r"|(?:2[1-69]|3[578]|42|5[09]|6[7-9]|8[0578]|9[679])[0-9])")
CUES = (
    r"(?i)(?:e-?mail|mail|contact|write|reply|correo|courriel|@)",
    r"(?i)(?:\bip\b|address|host|server|ping|client|login|adresse)",
    r"(?i)(?:card|visa|master|amex|credit|debit|payment|tarjeta|carte|karte)",
    r"(?i)(?:phone|\btel|call|fax|mobile|cell|whatsapp|telefon|t[eé]l[eé]|m[oó]vil)",
)
ODD_CUES = r"(?i)(?:version|\bv\.?\s?[0-9]*$|order|invoice|isbn|serial|\bid\b|sku|section|chapter|token|key|hash|sha|[$€£#]\s?$)"
LABELERS = ("shape", "check", "ends", "gazetteer", "words", "numbers")
FEATURES = (*LABELERS, "length", "place", "pieces")


def _text(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("long") if "doc_id" in docs.columns else F.lit(None).cast("long")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(doc_id.alias("doc_id"), F.translate(text, MARK, STAND_IN).alias("text"))


def cut(text: Column, pattern: str) -> Column:
    """What lies between matches and the matches themselves, in turn: the second, fourth and so on are matches."""
    return F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK)


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for each row, however often lambdas in it refer to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(sizes: Column, step: int = 512) -> Column:
    """Sums of the sizes before each, in blocks, as a sum that grows an array is slow on a long one."""
    nothing = F.array().cast("array<int>")

    def before(values: Column, start: Column) -> Column:
        return F.aggregate(values, F.struct(start.alias("at"), nothing.alias("all")), lambda state, size: F.struct(
            (state["at"] + size).alias("at"), F.concat(state["all"], F.array(state["at"])).alias("all")), lambda state: state["all"])

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda state, size: state + size)

    def joined(sizes: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), ((F.size(sizes) - 1) / step).cast("int")),
                             lambda i: F.slice(sizes, i * step + 1, F.lit(step)))
        return once(blocks, lambda each: F.flatten(F.zip_with(each, before(F.transform(each, total), F.lit(0)), before)))

    return once(sizes, joined)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _octets_fit(text: Column) -> Column:
    parts = F.split(F.regexp_replace(text, r"[\[(]\.[\])]", "."), r"\.")
    plain = F.transform(parts, lambda part: F.regexp_replace(part, "^0+(?=.)", ""))
    return F.forall(plain, lambda part: (F.length(part) <= 3) & F.coalesce(part.try_cast("int") <= 255, F.lit(False)))


def passes(kind: int, text: Column) -> Column:
    """The check of a kind: parts of an IP, digits and checksum of a card, digits of a phone."""
    if kind == 0:
        return F.lit(True)
    if kind == 1:
        return _octets_fit(text)
    count = F.length(_digits(text))
    if kind == 2:
        return F.when(count.between(12, 19), F.call_function("luhn_check", _digits(text))).otherwise(F.lit(False))
    return count.between(9, 15)


def _kind_of(text: Column) -> Column:
    """Kind of a match of the looser pattern."""
    return F.when(text.rlike(r"[\[(](?:at|AT)[\])]"), 0).when(text.rlike(r"[\[(]\.[\])]"), 1).when(
        text.rlike(r"^[0-9]{12,19}$|^[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}$|^[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}$"),
        2).otherwise(3)


def _by_kind(kind: Column, values: list[Column]) -> Column:
    out = F.when(kind == 0, values[0])
    for number, value in enumerate(values[1:], 1):
        out = out.when(kind == number, value)
    return out


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1 for yes, -1 for no, else 0; without ``no`` everything else is a no."""
    vote = F.when(yes, 1)
    return vote.otherwise(-1) if no is None else vote.when(no, -1).otherwise(0)


def _features(kind: Column, text: Column, good: Column, left: Column, right: Column) -> Column:
    """Votes of the labelers, then what only the classifier sees, each -1, 0 or 1."""
    digits, size = _digits(text), F.length(text)
    shape = _by_kind(kind, [
        _vote(text.rlike(r"^[A-Za-z0-9]+(?:[._%+-][A-Za-z0-9]+)*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}$"), text.rlike(r"[-.]$|^[._%+-]|\.\.")),
        _vote(text.rlike(r"^(?:0|[1-9][0-9]{0,2})(?:[\[(]?\.[\])]?(?:0|[1-9][0-9]{0,2})){3}$")),
        _vote(text.rlike(r"^[0-9]{15,16}$|^(?:[0-9]{4}[\x20-]){3}[0-9]{4}$|^[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}$"), text.rlike(r"[\x20-]")),
        _vote(text.rlike(r"^(?:\+|00)[0-9]"), ~text.rlike(r"[()\x20.-][0-9]{3}[\x20.-][0-9]{4}$"))])
    ends = _vote(~left.rlike(r"[A-Za-z0-9_]$") & ~right.rlike(r"^[A-Za-z0-9_]"))
    gazetteer = _by_kind(kind, [
        _vote(F.lower(text).rlike(rf"(?:\.|[\])]\x20?)(?:{ENDINGS})$")),
        _vote(~text.rlike(r"^(?:0|10|127|2[3-9][0-9]|22[4-9])\b")),
        _vote(digits.rlike(ISSUERS)),
        _vote(text.rlike(CALLING), text.rlike(r"^(?:\+|00)"))])
    words = _vote(_by_kind(kind, [left.rlike(cue) for cue in CUES]), left.rlike(ODD_CUES))
    numbers = F.when(left.rlike(r"[0-9][\x20|,;:\t]{1,3}$") | right.rlike(r"^[\x20|,;:\t]{1,3}[0-9]"), -1).otherwise(0)
    length = F.when(size < 12, -1).when(size <= 20, 0).otherwise(1)
    place = F.when(left.rlike(r"(?:^|\n)$") & right.rlike(r"^(?:\n|$)"), 1).when(left.rlike(r"[\x20\n]$"), 0).otherwise(-1)
    pieces = F.when(text.rlike(r"^[0-9]+$"), -1).when(text.rlike(r"[\x20()\[\]]"), 1).otherwise(0)
    return F.array(shape, _vote(good), ends, gazetteer, words, numbers, length, place, pieces)


def _matches(pieces: str, kind: int | None) -> Column:
    """kind, start, end, text, source and features of every match among the pieces."""
    cutting = F.col(pieces)

    def match(at: Column, i: Column) -> Column:
        before, text = F.element_at(cutting, 2 * i - 1), F.element_at(cutting, 2 * i)
        left = F.when(F.length(before) > CONTEXT_LEFT, F.substring(before, -CONTEXT_LEFT, CONTEXT_LEFT)).otherwise(before)
        return F.struct(F.element_at(at, 2 * i).alias("start"), text.alias("text"), left.alias("left"),
                        F.substring(F.element_at(cutting, 2 * i + 1), 1, CONTEXT_RIGHT).alias("right"))

    def judged(m: Column) -> Column:
        own = _kind_of(m["text"]) if kind is None else F.lit(kind)
        good = (_by_kind(own, [passes(k, m["text"]) for k in range(len(KINDS))]) if kind is None else passes(kind, m["text"]))
        source = F.lit(LOOSE) if kind is None else F.when(good, BASE).otherwise(FAILED)
        return F.struct(own.alias("kind"), m["start"].alias("start"), (m["start"] + F.length(m["text"])).alias("end"),
                        m["text"].alias("text"), source.alias("source"), good.alias("good"),
                        _features(own, m["text"], good, m["left"], m["right"]).alias("f"))

    numbers = F.sequence(F.lit(1), (F.size(cutting) / 2).cast("int"))
    found = once(running(F.transform(cutting, F.length)), lambda at: F.transform(F.transform(numbers, lambda i: match(at, i)), judged))
    return F.when(F.size(cutting) > 1, found).otherwise(F.array().cast(_CANDIDATES))


_CANDIDATES = "array<struct<kind:int,start:int,end:int,text:string,source:int,good:boolean,f:array<int>>>"


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and all candidates of every text.  A number too short for a card is no candidate."""
    names = (*KINDS, "loose")
    cuts = _text(docs).select("doc_id", *[
        cut(F.col("text"), pattern).alias(name) for name, pattern in zip(names, (*BASE_PATTERNS, LOOSE_PATTERN))])
    found = cuts.select("doc_id", *[
        _matches(name, None if name == "loose" else KINDS.index(name)).cast(_CANDIDATES).alias(name) for name in names])
    base = F.concat(*[F.filter(name, lambda b: b["source"] == BASE) for name in KINDS])
    apart = once(base, lambda spans: F.filter("loose", lambda c: c["good"] & ~F.exists(
        spans, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))))
    long_enough = F.filter("card", lambda c: F.length(_digits(c["text"])) >= 12)
    return found.select("doc_id", F.concat("email", "ip", long_enough, "phone", apart).alias("candidates"))


# Training: weights of kind x feature x value, as sums over the table of equal patterns.

Weights = dict[int, list[float]]
CELLS = [(j, v) for j in range(len(FEATURES)) for v in (-1, 0, 1)]


def patterns_of(found: DataFrame) -> DataFrame:
    """(kind, source, f, n): how many candidates have the same kind, source, votes and features."""
    each = found.select(F.explode("candidates").alias("c")).select("c.kind", "c.source", "c.f")
    return each.groupBy("kind", "source", "f").agg(F.count(F.lit(1)).cast("double").alias("n"))


def linear(kind: Column, f: Column, weights: Weights) -> Column:
    """Intercept and the weight of each feature's value."""
    # One constant: steps that differ in it alone share their compiled code.
    table = F.array(*[F.lit(float(w)) for k in range(len(KINDS)) for w in weights[k]])
    start = kind * (1 + len(CELLS)) + 1
    terms = [F.element_at(table, start + 3 * j + F.element_at(f, j + 1) + 2) for j in range(len(FEATURES))]
    return reduce(lambda a, b: a + b, terms, F.element_at(table, start))


def _sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def _sums(patterns: DataFrame, value: Column) -> Weights:
    """For each kind, the sum of a value over all candidates, then over those with each feature's value."""
    cells = F.array(F.lit(0), *[3 * j + F.element_at("f", j + 1) + 2 for j in range(len(FEATURES))])
    # A few thousand rows: one task, without a shuffle.
    rows = patterns.coalesce(1).select("kind", value.alias("value"), F.explode(cells).alias("cell")) \
        .groupBy("kind", "cell").agg(F.sum("value").alias("value")).collect()
    found = {k: [0.0] * (1 + len(CELLS)) for k in range(len(KINDS))}
    for kind, cell, total in rows:
        found[kind][cell] = total
    return found


# Before any vote: how often a labeler says -1, 0 and 1 of a span that is personal data, and of one that is not.
_BELIEF = {1: (0.1, 0.2, 0.7), 0: (0.5, 0.3, 0.2)}
# Log odds of a candidate before its votes, by source.
_ODDS = {BASE: 3.0, FAILED: -3.0, LOOSE: 0.0}


def posterior(weights: Weights) -> Column:
    by_source = F.when(F.col("source") == BASE, _ODDS[BASE]).when(F.col("source") == FAILED, _ODDS[FAILED]).otherwise(_ODDS[LOOSE])
    return _sigmoid(by_source + linear(F.col("kind"), F.col("f"), weights))


def reliabilities(patterns: DataFrame, rounds: int = EM_ROUNDS) -> Weights:
    """Log odds that each labeler's vote adds, by expectation-maximisation over all candidates."""
    def odds(yes: list[float], every: list[float]) -> list[float]:
        out = [0.0]
        for at, (j, v) in enumerate(CELLS, 1):
            if j >= len(LABELERS):
                out.append(0.0)
                continue
            share = [(part[at] + PRIOR_STRENGTH * _BELIEF[y][v + 1]) / (part[0] + PRIOR_STRENGTH)
                     for y, part in ((1, yes), (0, [a - b for a, b in zip(every, yes)]))]
            out.append(round(math.log(max(share[0], 1e-6) / max(share[1], 1e-6)), 6))
        return out

    every = _sums(patterns, F.col("n"))
    nothing = [0.0] * (1 + len(CELLS))
    weights = {k: odds(nothing, nothing) for k in every}
    for _ in range(rounds):
        yes = _sums(patterns, F.col("n") * posterior(weights))
        weights = {k: odds(yes[k], every[k]) for k in every}
    return weights


def span_classifier(patterns: DataFrame, votes: Weights, rounds: int = FIT_ROUNDS) -> Weights:
    """Logistic regression of the posteriors on all features.

    Each candidate has one value of each feature, so a step of gradient over a quarter of the candidates in a cell, times the
    number of features, never overshoots.
    """
    every = _sums(patterns, F.col("n"))
    weights = {k: [0.0] * (1 + len(CELLS)) for k in every}
    active = 1 + len(FEATURES)
    target = patterns.withColumn("target", posterior(votes))
    for _ in range(rounds):
        missing = _sums(target, F.col("n") * (F.col("target") - _sigmoid(linear(F.col("kind"), F.col("f"), weights))))
        weights = {k: [round(w + (g - RIDGE * w) / (active * n / 4 + RIDGE), 6) for w, g, n in zip(weights[k], missing[k], every[k])]
                   for k in weights}
    return weights


def personal_data(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id and ``spans`` by start: kind, start, end, text, base (or added by the classifier) and probability."""
    found = stored(candidates(docs), "candidates")
    patterns = stored(patterns_of(found), "patterns")
    weights = span_classifier(patterns, reliabilities(patterns))
    scored = F.transform("candidates", lambda c: F.struct(
        c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), c["text"].alias("text"), c["source"].alias("source"),
        _sigmoid(linear(c["kind"], c["f"], weights)).alias("probability")))
    kept = F.filter("scored", lambda c: (c["source"] == BASE) | ((c["source"] == LOOSE) & (c["probability"] >= least)))
    names = F.array(*[F.lit(name) for name in KINDS])
    spans = F.transform(F.array_sort("kept"), lambda c: F.struct(
        F.element_at(names, c["kind"] + 1).alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["text"].alias("text"),
        (c["source"] == BASE).alias("base"), c["probability"].alias("probability")))
    return found.withColumn("scored", scored).select("doc_id", kept.alias("kept")).select("doc_id", spans.alias("spans"))


def digests(found: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of ``personal_data``'s rows."""
    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = found.withColumn("base", F.filter("spans", lambda s: s["base"]))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return base.select("doc_id", *[count(kind) for kind in KINDS],
                       F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
