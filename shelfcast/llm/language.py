"""Language ID: Bayesian fusion of what the text, its declared language, its address and its host say.

Text likelihoods are byte-trigram models of every language that any document declares; the counts are sums over the
whole corpus.  Models are made and scored in rounds of ROUND languages, one broadcast each, and a task holds one round at a
time, so memory does not grow with the number of languages; the work of scoring does.  ``und`` stands for no language: every trigram is as likely as any other.  From the
text alone, each document gets a first language, and grouped counts of first languages by host give the
priors: a host's counts are smoothed towards its address suffix, those towards the whole corpus.  How far a declared language is
to be trusted is counted as well, by the table of declared against first languages.  The posterior adds up the logarithms.

A document is rejected if no language is likelier than THRESHOLD: no letters, or text like none of them.

Skew: counts by host are summed in each task first; host tables hold only the languages found there and join without a
hint, so Spark broadcasts them when small and splits a hot host when not.  A task counts at most HELD languages at a time
and gives out the rarest when another one comes.  Scores are made twice rather than stored.

Defined results.  Null or empty text: ``und``, rejected.  A null host or declared language adds nothing.  Every input row
gives one row, repeated or not, with or without doc_id; its columns are carried along in ``doc``, whatever their names.  In a
corpus in which nothing is declared every text is ``und``.  Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shelfcast.llm.chunks import ship, squeeze, unsqueeze
from shelfcast.llm.graph import stored
from shelfcast.llm.words import LOWER, slices, text_bytes

UNKNOWN = "und"
SLOT_BITS = 16
ROUND = 64
"""Languages scored at a time: 64 x 65,536 numbers, 16 MB."""
HELD = 64
"""Languages whose trigrams a task counts at the same time: 64 x 65,536 numbers, 32 MB."""
SMOOTHING = 0.5
TEMPER = 1 / 3
"""Overlapping trigrams count every letter three times."""
HOST_WEIGHT = 20.0
"""Prior documents that a host's counts must outweigh."""
UNKNOWN_PRIOR = 1e-3
THRESHOLD = 0.5
# Address suffixes that belong to one language.
SUFFIXES = {"uk": "en", "us": "en", "au": "en", "ie": "en", "nz": "en", "fr": "fr", "de": "de", "at": "de", "es": "es",
            "mx": "es", "ar": "es", "cl": "es", "co": "es", "pe": "es", "it": "it", "pt": "pt", "br": "pt", "nl": "nl",
            "pl": "pl", "se": "sv", "dk": "da", "fi": "fi", "no": "no", "cz": "cs", "ru": "ru", "jp": "ja", "cn": "zh"}
SUFFIX_LIFT = 3.0
"""How much likelier an address of a language's own suffix is for that language."""

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def declared_code(column):
    """``en-US`` and ``EN`` are ``en``; anything else than letters is no declaration."""
    code = F.regexp_extract(F.lower(F.trim(column.cast("string"))), r"^([a-z]{2,8})(?:[-_].*)?$", 1)
    return F.when(code.isin("", UNKNOWN), None).otherwise(code)


def host_suffix(host):
    return F.lower(F.regexp_extract(host, r"\.([A-Za-z]{2,})(?::\d+)?$", 1))


def markup_language(html):
    """What a page's own markup declares: the lang attribute of its html element, or else its content-language."""
    page = html.cast("string")
    own = F.regexp_extract(page, r"""(?i)<html\b[^>]*?\s(?:xml:)?lang\s*=\s*["']?\s*([A-Za-z][A-Za-z0-9_-]*)""", 1)
    meta = F.regexp_extract(page, r"""(?i)<meta\b[^>]*?http-equiv\s*=\s*["']?content-language["']?[^>]*?content\s*=\s*["']?\s*([A-Za-z][A-Za-z0-9_-]*)""", 1)
    return F.coalesce(F.nullif(own, F.lit("")), F.nullif(meta, F.lit("")))


def url_host(url):
    """The host of an address, lower-cased, without user and port; null where there is none."""
    host = F.regexp_extract(url.cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.lower(host), F.lit(""))


def page_text(html):
    """What a page shows, as far as letters go: scripts, styles, comments, tags and entities are out."""
    inner = F.regexp_replace(html.cast("string"), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[A-Za-z0-9#]+;", " ")
    return F.trim(inner)


def identify_pages(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``identify`` for raw pages: the declared language from the markup, host and suffix from the address.

    One row for each page: ``page`` (its columns), ``language``, ``confidence``, ``keep``.  A null page is ``und``.
    """
    rows = pages.select(F.struct("*").alias("page")).select(
        "page", page_text(F.col(f"page.{html}")).alias("text"), markup_language(F.col(f"page.{html}")).alias("lang"),
        url_host(F.col(f"page.{url}")).alias("source"))
    return identify(rows).select("doc.page", "language", "confidence", "keep")


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the letter trigrams of all texts, and n + 1 offsets; what is not a letter counts as one space."""
    letter = _LETTER[data]
    value = np.where(letter, LOWER[data], 32).astype(np.uint32)
    if len(value) < 3:
        return np.zeros(0, dtype=np.uint32), np.zeros(len(offsets), dtype=np.int64)
    slot = ((value[:-2] << np.uint32(16)) | (value[1:-1] << np.uint32(8)) | value[2:]) * np.uint32(0x9E3779B1)
    keep = letter[1:-1] | (letter[:-2] & letter[2:])
    bounds = offsets[1:-1]
    for back in (1, 2):
        cut = bounds - back
        keep[cut[(cut >= 0) & (cut < len(keep))]] = False
    at = np.flatnonzero(keep)
    return slot[at] >> np.uint32(32 - SLOT_BITS), np.searchsorted(at, offsets)


def _count(languages: tuple[str, ...], most: int = HELD):
    def row(i: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array([i], pa.int32()), pa.array([squeeze(total)], pa.binary())],
                               names=["language", "counts"])

    def count(batches):
        held, sums = {}, {}
        number = {code: i for i, code in enumerate(languages)}
        for batch in batches:
            data, offsets = text_bytes(batch["text"])
            code = np.array([number.get(c, -1) for c in batch["code"].to_pylist()])
            for low, high in slices(offsets):
                part = offsets[low:high + 1]
                slots, ends = trigrams(data[part[0]:part[-1]], part - part[0])
                own = np.repeat(code[low:high], np.diff(ends))
                order = np.argsort(own, kind="stable")
                own, slots = own[order], slots[order]
                for i in np.unique(own[own >= 0]).tolist():
                    if i not in held and len(held) >= most:
                        rarest = min(sums, key=sums.get)
                        sums.pop(rarest)
                        yield row(rarest, held.pop(rarest))
                    mine = slots[np.searchsorted(own, i):np.searchsorted(own, i, side="right")]
                    if i not in held:
                        held[i], sums[i] = np.zeros(1 << SLOT_BITS, dtype=np.uint64), 0
                    held[i] += np.bincount(mine, minlength=1 << SLOT_BITS).astype(np.uint64)
                    sums[i] += len(mine)
        for i, total in held.items():
            yield row(i, total)
    return count


def _add(table: pa.Table) -> pa.Table:
    total = sum(unsqueeze(blob) for blob in table["counts"].to_pylist())
    return pa.table({"language": table["language"][:1].cast(pa.int32()),
                     "counts": pa.array([squeeze(total)], pa.binary())})


def text_models(texts: DataFrame, languages: tuple[str, ...], size: int) -> Iterator[np.ndarray]:
    """Log-likelihood ratio of each trigram slot against ``und`` for ``size`` languages after the other."""
    rows = texts.mapInArrow(_count(languages), "language int, counts binary").groupBy("language") \
        .applyInArrow(_add, "language int, counts binary")
    if len(languages) > size:
        rows = stored(rows, "trigrams")
    for low in range(0, len(languages), size):
        counts = np.zeros((min(size, len(languages) - low), 1 << SLOT_BITS))
        for language, blob in rows.filter(F.col("language").between(low, low + size - 1)).collect():
            counts[language - low] = unsqueeze(bytes(blob))
        counts += SMOOTHING
        yield (np.log(counts / counts.sum(axis=1, keepdims=True)) + np.log(1 << SLOT_BITS)).astype(np.float32)


def _rounds(shared: list) -> Iterator[tuple[int, np.ndarray]]:
    """First language and models of each round; of several rounds none stays in the worker."""
    low = 0
    for models in shared:
        ratios = models.value if len(shared) == 1 else models.load_from_path(models._path)
        yield low, ratios
        low += len(ratios)


def text_scores(data: np.ndarray, offsets: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """One row for each text: tempered log-likelihood ratio of each language against ``und``; all NaN without letters."""
    out = np.full((len(offsets) - 1, len(ratios)), np.nan)
    for low, high in slices(offsets):
        part = offsets[low:high + 1]
        slots, ends = trigrams(data[part[0]:part[-1]], part - part[0])
        full = np.flatnonzero(np.diff(ends))
        if len(full):
            for i, ratio in enumerate(ratios):
                out[low + full, i] = TEMPER * np.add.reduceat(ratio[slots], ends[full], dtype=np.float64)
    return out


def _first(shared: list):
    def first(batches):
        for batch in batches:
            data, offsets = text_bytes(batch["text"])
            best, most = np.full(len(batch), -1), np.zeros(len(batch))
            for low, ratios in _rounds(shared):
                scores = text_scores(data, offsets, ratios)
                scores[np.isnan(scores)] = -np.inf
                own = np.argmax(scores, axis=1)
                top = scores[np.arange(len(own)), own]
                better = (top > most) | ((top == most) & (best < 0))
                best[better], most[better] = low + own[better], top[better]
            yield pa.record_batch([batch["host"], batch["code"], pa.array(best, pa.int32())],
                                  names=["host", "code", "first"])
    return first


def _smoothed(counts: DataFrame, size: int) -> tuple[DataFrame, np.ndarray]:
    """Hosts with what was counted there and below their suffix, (language, documents) each, and the prior of the
    whole corpus."""
    overall = np.ones(size)
    for i, n in counts.filter("first >= 0").groupBy("first").agg(F.sum("n")).collect():
        overall[i] += n
    by_host = counts.filter("host is not null").groupBy("host", "first").agg(F.sum("n").alias("n")) \
        .withColumn("suffix", host_suffix(F.col("host")))

    def found(name: str):
        return F.collect_list(F.when(F.col("first") >= 0, F.struct("first", F.col("n").cast("double").alias("n")))).alias(name)

    hosts = by_host.groupBy("host", "suffix").agg(found("of_host"))
    suffixes = by_host.groupBy("suffix", "first").agg(F.sum("n").alias("n")).groupBy("suffix").agg(found("of_suffix"))
    return hosts.join(suffixes, "suffix", "left").select("host", "of_host", "of_suffix"), overall / overall.sum()


class _Counts:
    """A batch's lists of (language, documents)."""

    def __init__(self, lists):
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        self.known = np.array(lists.is_valid())
        self.row = np.array(pc.list_parent_indices(lists), dtype=np.int64)
        flat = pc.list_flatten(lists)
        self.language = np.array(pc.struct_field(flat, "first"), dtype=np.int64)
        self.n = np.array(pc.struct_field(flat, "n"), dtype=np.float64)
        self.whole = np.bincount(self.row, self.n, minlength=len(self.known))

    def smoothed(self, low: int, upper: np.ndarray) -> np.ndarray:
        """Shares of the languages from ``low``, with HOST_WEIGHT documents spread like ``upper``."""
        out = HOST_WEIGHT * upper
        mine = np.flatnonzero((self.language >= low) & (self.language < low + out.shape[1]))
        out[self.row[mine], self.language[mine] - low] += self.n[mine]
        return out / (self.whole + HOST_WEIGHT)[:, None]


@dataclass
class Trust:
    """How often each declared language met each first language; log P(declared | language) with one more for each pair."""

    declared: np.ndarray
    first: np.ndarray
    n: np.ndarray
    size: int

    def table(self, low: int, high: int, declared: np.ndarray) -> np.ndarray:
        """Rows for the languages ``declared``, in ascending order, columns for the languages low:high."""
        out = np.ones((len(declared), high - low))
        if not len(declared):
            return out
        row = np.minimum(np.searchsorted(declared, self.declared), len(declared) - 1)
        mine = np.flatnonzero((self.first >= low) & (self.first < high) & (declared[row] == self.declared))
        out[row[mine], self.first[mine] - low] += self.n[mine]
        return np.log(out / (self.size + np.bincount(self.first, self.n, minlength=self.size)[low:high]))


def _judge(text, shared: list, languages, overall, trust, schema):
    names = np.array([*languages, UNKNOWN])
    number = {code: i for i, code in enumerate(languages)}

    def judge(batches):
        for batch in batches:
            n = len(batch)
            data, offsets = text_bytes(pc.struct_field(batch["doc"], text))
            of_host, of_suffix = _Counts(batch["of_host"]), _Counts(batch["of_suffix"])
            code = np.array([number.get(c, -1) for c in batch["code"].to_pylist()], dtype=np.int64)
            stated = np.flatnonzero(code >= 0)
            declared, place = np.unique(code[stated], return_inverse=True)
            suffix = np.array([number.get(SUFFIXES.get(s), -1) for s in batch["suffix"].to_pylist()], dtype=np.int64)
            best, most, total = np.full(n, len(languages)), np.full(n, np.log(UNKNOWN_PRIOR)), np.ones(n)
            for low, ratios in _rounds(shared):
                high = low + len(ratios)
                scores = text_scores(data, offsets, ratios)
                prior = np.repeat(overall[None, low:high], n, axis=0)
                prior = np.where(of_host.known[:, None], of_host.smoothed(low, of_suffix.smoothed(low, prior)), prior)
                scores += np.log(prior)
                scores[stated] += trust.table(low, high, declared)[place]
                lifted = np.flatnonzero((suffix >= low) & (suffix < high))
                scores[lifted, suffix[lifted] - low] += np.log(SUFFIX_LIFT)
                scores[np.isnan(scores)] = -np.inf
                own = np.argmax(scores, axis=1)
                top = scores[np.arange(n), own]
                better = (top > most) | ((top == most) & (best == len(languages)))
                best[better] = low + own[better]
                peak = np.maximum(most, top)
                total = total * np.exp(most - peak) + np.exp(scores - peak[:, None]).sum(axis=1)
                most = peak
            sure = 1 / total
            keep = (best < len(languages)) & (sure > THRESHOLD)
            yield pa.RecordBatch.from_arrays(
                [batch["doc"].cast(schema.field("doc").type), pa.array(names[best], pa.string()),
                 pa.array(sure, pa.float64()), pa.array(keep, pa.bool_())], schema=schema)
    return judge


def identify(docs: DataFrame, text: str = "text", declared: str = "lang", host: str = "source") -> DataFrame:
    """One row for each document: ``doc`` (its columns), ``language``, ``confidence``, ``keep``."""
    spark = docs.sparkSession
    ship(spark)
    inputs = docs.select(F.struct("*").alias("doc")).select(
        "doc", F.col(f"doc.{text}").cast("string").alias("text"), declared_code(F.col(f"doc.{declared}")).alias("code"),
        F.col(f"doc.{host}").cast("string").alias("host"))
    languages = tuple(sorted(r[0] for r in inputs.filter("code is not null").select("code").distinct().collect()))
    if not languages:
        return inputs.select("doc", F.lit(UNKNOWN).alias("language"), F.lit(1.0).alias("confidence"),
                             F.lit(False).alias("keep"))
    shared = [spark.sparkContext.broadcast(m) for m in text_models(inputs.select("text", "code"), languages, ROUND)]
    counts = inputs.select("text", "code", "host").mapInArrow(_first(shared), "host string, code string, first int") \
        .groupBy("host", "code", "first").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts, "languages")
    priors, overall = _smoothed(counts, len(languages))
    number = {code: i for i, code in enumerate(languages)}
    pairs = counts.filter("code is not null and first >= 0").groupBy("code", "first").agg(F.sum("n")).collect()
    met = np.array([(number[code], first, n) for code, first, n in pairs], dtype=np.int64).reshape(-1, 3)
    trust = Trust(met[:, 0], met[:, 1], met[:, 2].astype(np.float64), len(languages))
    schema = StructType().add("doc", docs.select(F.struct("*").alias("doc")).schema[0].dataType) \
        .add("language", "string").add("confidence", "double").add("keep", "boolean")
    judged = inputs.join(priors, "host", "left").select(
        "doc", "code", host_suffix("host").alias("suffix"), "of_host", "of_suffix")
    return judged.mapInArrow(_judge(text, shared, languages, overall, trust, to_arrow_schema(schema)), schema)
