"""The language of texts and pages, from several kinds of evidence.

What a text's letters say is a likelihood from counts of byte trigrams over all
labelled texts. With it, the reliability of the language a page declares
and of its address's suffix is estimated, and a prior for each host, smoothed towards its domain's, and that
towards all. Bayes' rule puts them together. All counts are grouped sums.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import WORD_BYTES, mapped, stored

BUCKETS = 1 << 14
LANGUAGES = 512  # the labels that have most trigrams; others are no languages

HIDDEN = re.compile(r"<(?:(script|style)\b|(!--))?", re.IGNORECASE)
ENDS = {name: re.compile(rf"</{name}\s*+>", re.IGNORECASE) for name in ("script", "style")} | {"!--": re.compile("-->")}
HTML = re.compile(r"<html\b", re.IGNORECASE)
DECLARED = re.compile(r"<html\b[^>]*?\s(?:xml:)?lang\s*+=\s*+[\"']?+\s*+([a-z]{2,3})\b", re.IGNORECASE)
NULLS = 4096  # keys that rows without a value are dealt over


@dataclass(frozen=True)
class Fusion:
    """``full_text`` trigrams and more weigh alike; ``host_weight`` and ``domain_weight`` are records
    a prior is worth; ``smoothing`` is added to counts of trigrams, declarations and suffixes."""

    full_text: int = 200
    host_weight: float = 10.0
    domain_weight: float = 10.0
    smoothing: float = 0.5


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all texts' trigrams, and where those of each text start and end in turn."""
    parts = [b" %b   " % b" ".join(text.encode().translate(WORD_BYTES).split()) for text in texts]
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint32)
    code = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    buckets = ((code * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int32)
    ends = np.cumsum([0, *map(len, parts)])
    # A text's last trigrams are of blanks only, and the very last ones would reach into the next text.
    return buckets, np.stack([ends[:-1], ends[1:] - 4], 1)


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, text -> lang, bucket, n: the trigram counts of a task's texts."""
    counts: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS, np.int64))
    for batch in batches:
        by_language = defaultdict(list)
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            by_language[lang].append(text.as_py())
        for lang, texts in by_language.items():
            for start in range(0, len(texts), 512):
                buckets, spans = trigrams(texts[start : start + 512])
                inside = np.zeros(len(buckets) + 1, np.int32)
                np.add.at(inside, np.minimum(spans[:, 0], len(buckets)), 1)
                np.add.at(inside, np.minimum(spans[:, 1], len(buckets)), -1)
                counts[lang] += np.bincount(buckets[np.cumsum(inside[:-1]) > 0], minlength=BUCKETS)
    for lang, n in counts.items():
        found = np.flatnonzero(n)
        columns = [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int32()), pa.array(n[found])]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])


@dataclass(frozen=True)
class TextModel:
    """Languages in order, the logarithm of each trigram's probability, and of each language's share."""

    languages: tuple[str, ...]
    likelihood: np.ndarray
    share: tuple[float, ...]


def fit(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", rule: Fusion = Fusion()) -> TextModel:
    """Count the trigrams of every labelled text. Rows without a label or a text are left out.

    Of more than ``LANGUAGES`` labels those with most trigrams are languages, of equal ones the first by
    name. The driver gets a sum for each language and bucket; without any label it is one
    language without a name, ``und``.
    """
    rows = docs.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("text"))
    rows = rows.where("lang is not null and text is not null")
    counts = mapped(rows, count_batches, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = stored(counts, "trigrams")
    largest = counts.groupBy("lang").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "lang").limit(LANGUAGES).select("lang")
    found = counts.join(F.broadcast(largest), "lang", "left_semi").toArrow()
    languages = sorted(set(found["lang"].to_pylist()))
    if not languages:
        return TextModel(("und",), np.zeros((1, BUCKETS), np.float32), (0.0,))
    table = np.full((len(languages), BUCKETS), rule.smoothing)
    place = {lang: k for k, lang in enumerate(languages)}
    table[[place[lang] for lang in found["lang"].to_pylist()], found["bucket"].to_numpy()] += found["n"].to_numpy()
    sums = table.sum(axis=1)
    return TextModel(tuple(languages), np.log(table / sums[:, None]).astype(np.float32), tuple(np.log(sums / sums.sum()).tolist()))


def address(url: str | None) -> tuple[str | None, str | None, str | None]:
    """Host, domain and suffix of an address; a name without dots is a host alone."""
    if not url:
        return None, None, None
    try:
        host = urlsplit(url).hostname if "://" in url else url
    except ValueError:
        return None, None, None
    if not host:
        return None, None, None
    labels = host.lower().strip(".").split(".")
    if len(labels) == 1:
        return labels[0], None, None
    return ".".join(labels), ".".join(labels[-2:]), labels[-1]


def plain(markup: str) -> str:
    """The text of a page without its tags, comments, scripts and styles, in one pass; what is never closed is a tag."""
    out, at, lacking = [], 0, set()
    while (opened := HIDDEN.search(markup, at)) is not None:
        kind = (opened[1] or opened[2] or "").lower()
        end = -1
        if kind and kind not in lacking:
            closed = ENDS[kind].search(markup, opened.start() + len(kind) + 1)
            end = closed.end() if closed else -1
            if not closed:
                lacking.add(kind)  # nor is there one for those that follow
        if end < 0:
            end = markup.find(">", opened.start() + 1) + 1
            if not end:
                break
        out.append(markup[at : opened.start()])
        at = end
    out.append(markup[at:])
    return html.unescape(" ".join(out))


def declared_language(markup: str) -> str | None:
    """The language that the page's first html tag declares."""
    tag = HTML.search(markup)
    found = tag and DECLARED.match(markup, tag.start())
    return found[1].lower() if found else None


SCORED = "id long, host string, domain string, suffix string, declared string, n_trigrams long, p array<double>"


def score_batches(batches: Iterator[pa.RecordBatch], model: TextModel, rule: Fusion, markup: bool) -> Iterator[pa.RecordBatch]:
    """id, address, text -> the evidence of a record; p is what its text says, with equal priors."""
    n = len(model.languages)
    for batch in batches:
        for begin in range(0, batch.num_rows, 512):
            part = batch.slice(begin, 512)
            raw = [scalar.as_py() or "" for scalar in part.column(2)]
            declared = [declared_language(text) for text in raw] if markup else [None] * len(raw)
            buckets, spans = trigrams([plain(text) for text in raw] if markup else raw)
            sizes = spans[:, 1] - spans[:, 0]
            evidence = np.zeros((len(raw), n))
            for k, row in enumerate(model.likelihood):
                sums = np.concatenate([[0.0], np.cumsum(row[buckets], dtype=np.float64)])
                evidence[:, k] = np.where(sizes > 0, sums[np.maximum(spans[:, 1], spans[:, 0])] - sums[spans[:, 0]], 0.0)
            # The mean of a text is worth what it has of trigrams, up to a limit.
            evidence *= (np.minimum(sizes, rule.full_text) / np.maximum(sizes, 1))[:, None]
            p = np.exp(evidence - evidence.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            places = list(zip(*map(address, part.column(1).to_pylist()), strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    *(pa.array(place, pa.string()) for place in places),
                    pa.array(declared, pa.string()),
                    pa.array(np.maximum(sizes, 0), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(raw) + 1) * n, pa.int32()), pa.array(p.ravel())),
                ],
                names=[field.split()[0] for field in SCORED.split(", ")],
            )


def _sums(n: int) -> Column:
    return F.array(*(F.sum(F.get("p", F.lit(k))) for k in range(n)))


def _prior(own: Column, count: Column, wider: Column, weight: float) -> Column:
    """Shares of the languages in a group, smoothed towards those of a wider one."""
    return F.zip_with(own, wider, lambda x, y: (F.greatest(x, F.lit(0.0)) + y * weight) / (count + weight))


def _reliability(scored: DataFrame, name: str, n: int, rule: Fusion) -> DataFrame:
    """How likely each language's records have a value of a kind of evidence."""
    groups = scored.where(F.col(name).isNotNull()).groupBy(name).agg(_sums(n).alias("own"))
    totals = [F.coalesce(F.sum(F.get("own", F.lit(k))), F.lit(0.0)) for k in range(n)]
    whole = groups.agg(F.array(*totals).alias("own"), F.count(F.lit(1)).alias("values")).first()
    all_values = F.array(*(F.lit(x + whole["values"] * rule.smoothing) for x in whole["own"]))
    given = F.zip_with("own", all_values, lambda x, y: (x + rule.smoothing) / y)
    return groups.select(F.col(name).alias(f"{name}_value"), given.alias(f"{name}_given"))


def fuse(scored: DataFrame, languages: tuple[str, ...], rule: Fusion = Fusion()) -> DataFrame:
    """Each record with its language, the probability of it, and what its text alone says.

    ``scored`` is read several times: store it first. A record's own text does
    not count in the priors of its host and domain. Missing evidence says nothing; a record
    without any has the prior of all.
    """
    n = len(languages)
    whole = scored.agg(_sums(n).alias("own"), F.count(F.lit(1)).alias("n")).first()
    all_prior = F.array(*(F.lit(((x or 0.0) + 1 / n) / (whole["n"] + 1)) for x in whole["own"]))
    domains = scored.where("domain is not null").groupBy("domain").agg(_sums(n).alias("domain_sums"), F.count(F.lit(1)).alias("domain_n"))
    hosts = scored.where("host is not null").groupBy("host").agg(_sums(n).alias("host_sums"), F.count(F.lit(1)).alias("host_n"))
    domains, hosts = domains.withColumnRenamed("domain", "domain_value"), hosts.withColumnRenamed("host", "host_value")
    joined = scored
    for name, known in (
        ("domain", domains),
        ("host", hosts),
        ("declared", _reliability(scored, "declared", n, rule)),
        ("suffix", _reliability(scored, "suffix", n, rule)),
    ):
        # Rows without a value are dealt over many keys that no value has.
        none = F.concat(F.lit("\x00"), F.pmod(F.xxhash64("id", "host", "n_trigrams"), F.lit(NULLS)).cast("string"))
        joined = joined.join(known, F.coalesce(F.col(name), none) == F.col(f"{name}_value"), "left")

    def without_self(sums: str) -> Column:
        return F.zip_with(sums, "p", lambda x, y: x - y)

    def spoken(name: str) -> Column:
        return F.coalesce(name, F.array_repeat(F.lit(1.0), n))

    domain = _prior(without_self("domain_sums"), F.col("domain_n") - 1, all_prior, rule.domain_weight)
    joined = joined.withColumn("wider", F.when(F.col("domain_n").isNull(), all_prior).otherwise(domain))
    host = _prior(without_self("host_sums"), F.col("host_n") - 1, F.col("wider"), rule.host_weight)
    joined = joined.withColumn("prior", F.when(F.col("host_n").isNull(), F.col("wider")).otherwise(host))
    product = F.zip_with("p", "prior", lambda x, y: (x + 1e-12) * y)
    for name in ("declared_given", "suffix_given"):
        product = F.zip_with(product, spoken(name), lambda x, y: x * y)
    names = F.array(*map(F.lit, languages))

    def best(values: Column) -> Column:
        return F.get(names, (F.array_position(values, F.array_max(values)) - 1).cast("int"))

    total = F.aggregate("weights", F.lit(0.0), lambda x, y: x + y)
    return (
        joined.withColumn("weights", product)
        .withColumn("probability", F.array_max("weights") / total)
        .withColumn("lang", best(F.col("weights")))
        .withColumn("text_lang", F.when(F.col("n_trigrams") > 0, best(F.col("p"))))
        .select("id", "lang", "probability", "text_lang", "declared", "suffix", "host", "n_trigrams")
    )


def identify(
    records: DataFrame, model: TextModel, id_column: str, text_column: str, address_column: str, markup: bool, rule: Fusion = Fusion()
) -> DataFrame:
    """One row per row of ``records``: its language and what spoke for it.

    The address may be an url or a plain name of a source. With ``markup`` the
    text is a page: its tags, scripts and styles are left out and its declared
    language is read. Null and empty texts, addresses and declarations are
    missing evidence; a null id stays null; repeated rows are each reported.
    """
    rows = records.select(
        F.col(id_column).cast("long").alias("id"), F.col(address_column).cast("string").alias("address"), F.col(text_column).alias("text")
    )
    return fuse(stored(mapped(rows, score_batches, SCORED, model, rule, markup), "evidence"), model.languages, rule)
