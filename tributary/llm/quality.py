"""Quality rules: counts over a text's words, and lines that too many documents of one host share.

A line is compared by the hash of its words, lower-cased. Lines found in more
documents of a host than the limits allow are removed; a document that loses
too much by it is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import ASCII_LOWER, joinable, mapped, same, stored, text_key, unused, without_lines


@dataclass(frozen=True)
class LineLimits:
    """A line goes when over ``min_documents`` and over ``share`` of a host's documents have it.

    A document is depleted when under ``min_words`` or under ``min_left`` of its words are left.
    """

    min_documents: int = 8
    share: float = 0.1
    min_words: int = 10
    min_left: float = 0.5


SYMBOLS = b"#*$%&|<>"
NO_SYMBOLS = bytes(set(range(256)) - set(SYMBOLS))
CONTINUED = bytes(range(128, 192))
WINDOW = 5
PROFILE = (
    "doc_id long, host string, text_hash long, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, lines array<struct<hash: long, words: int>>"
)


def repeat_words(words: list[bytes], n: int = WINDOW) -> int:
    """Words inside windows of n words that the text has twice or more, the first included."""
    windows = len(words) - n + 1
    if windows < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(word, len(known)) for word in words], np.int64)
    # Ranks of windows of 1, 2, 3, ... words: exact, as ranks and ids stay far below 2**31.
    code = ids[:windows]
    width = len(known)
    for step in range(1, n):
        code = code * len(known) + ids[step : step + windows]
        width *= len(known)
        if width * len(known) >= 2**63 or step == n - 1:
            distinct, code = np.unique(code, return_inverse=True)
            width = len(distinct)
    twice = np.bincount(code, minlength=width)[code] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(twice), 1)
    np.add.at(edges, np.flatnonzero(twice) + n, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def profile_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: list[list[int]] = [[] for _ in range(5)]
        hashes: list[int] = []
        sizes: list[int] = []
        offsets = [0]
        for scalar in batch.column(3):
            data = (scalar.as_py() or "").encode()
            words = data.split()
            chars = sum(map(len, words))
            chars -= len(data) - len(data.translate(None, CONTINUED))
            seen: set[bytes] = set()
            repeated = 0
            for line in data.split(b"\n"):
                parts = line.split()
                if parts:
                    repeated += line in seen
                    seen.add(line)
                    hashes.append(xxhash.xxh3_64_intdigest(b" ".join(parts).translate(ASCII_LOWER)) - 2**63)
                else:
                    hashes.append(0)
                sizes.append(len(parts))
            offsets.append(len(hashes))
            row = (len(words), chars, len(data.translate(None, NO_SYMBOLS)), repeated, repeat_words(words))
            for column, value in zip(counts, row, strict=True):
                column.append(value)
        lines = pa.StructArray.from_arrays([pa.array(hashes, pa.int64()), pa.array(sizes, pa.int32())], ["hash", "words"])
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(i) for i in range(3)),
                *(pa.array(column, pa.int64()) for column in counts),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), lines),
            ],
            names=["doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"],
        )


def profiles(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source") -> DataFrame:
    """One row per row of ``docs``: the base counts, and hash and length of every line in order."""
    text = F.col(text_column)
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(host_column).cast("string").alias("host"),
        text_key(text).alias("text_hash"),
        text.alias("text"),
    )
    return mapped(rows, profile_batches, PROFILE)


def frequent_lines(profile: DataFrame, limits: LineLimits) -> DataFrame:
    """The lines above the limits: host and hash. Copies of a line within a document count once."""
    hosts = profile.select("host", "doc_id").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("documents"))
    lines = F.array_distinct(F.transform(F.filter("lines", lambda line: line.words > 0), lambda line: line.hash))
    holders = (
        profile.select("host", "doc_id", F.explode(lines).alias("hash"))
        .distinct()
        .groupBy("host", "hash")
        .agg(F.count(F.lit(1)).alias("holders"))
        .where(F.col("holders") > limits.min_documents)
    )
    return (
        holders.alias("l")
        .join(hosts.alias("h"), same(F.col("l.host"), F.col("h.host")))
        .where(F.col("holders") > F.col("documents") * limits.share)
        .select(F.col("l.host").alias("host"), "hash")
    )


def judged(profile: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """Every profile with the verdict of both rule sets and the numbers of the lines to remove.

    ``profile`` is read several times: store it first. Rows of one id with the
    same text count as one document and get the same verdict.
    """
    key = ["doc_id", "host", "text_hash"]
    each = profile.select(*key, F.posexplode("lines").alias("number", "line"))
    f = frequent_lines(profile, limits).withColumnsRenamed({"host": "f_host", "hash": "f_hash"})
    gone = (
        each.join(f, same(F.col("host"), F.col("f_host")) & (F.col("line.hash") == F.col("f_hash")))
        .where("line.words > 0")
        .groupBy(*key, "number")
        .agg(F.first("line.words").alias("words"))
        .groupBy(*key)
        .agg(F.sum("words").alias("words_removed"), F.collect_set("number").alias("lines_removed"))
        .withColumnsRenamed({name: f"g_{name}" for name in key})
    )
    left = F.col("n_words") - F.col("words_removed")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    depleted = (F.col("words_removed") > 0) & (
        (left < limits.min_words) | (left < F.col("n_words") * limits.min_left)
    )
    matches = [same(F.col(name), F.col(f"g_{name}")) for name in key]
    return (
        profile.join(gone, matches[0] & matches[1] & matches[2], "left")
        .withColumn("words_removed", F.coalesce("words_removed", F.lit(0)))
        .withColumn("lines_removed", F.coalesce("lines_removed", F.array().cast("array<int>")))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & ~depleted)
        .drop("lines", *(f"g_{name}" for name in key))
    )


def judge_documents(docs: DataFrame, limits: LineLimits = LineLimits(), **columns: str) -> DataFrame:
    """One row per row of ``docs``: base counts, ``words_removed``, ``base_failed`` and ``kept``.

    A null or empty text has no words and fails; a null host is a host of its own;
    a null id is an id of its own; an empty table gives no rows.
    """
    return judged(stored(profiles(docs, **columns), "quality"), limits).drop("host", "text_hash", "lines_removed")


def keep_good(docs: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """The documents that pass, without the lines above the limits; the columns of ``docs`` as they were.

    ``n_chars``, where there is one, follows the text.
    """
    verdicts = judged(stored(profiles(docs), "quality"), limits).where("not kept or size(lines_removed) > 0")
    name = unused(docs, "_verdict_")
    verdict = F.struct("doc_id", "host", "text_hash", "kept", "lines_removed").alias(name)
    verdicts = stored(verdicts.select(verdict).distinct(), "verdicts")
    verdict = F.col(name)
    matches = (
        same(F.col("doc_id").cast("long"), verdict.doc_id)
        & same(F.col("source").cast("string"), verdict.host)
        & (text_key(F.col("text")) == verdict.text_hash)
    )
    text = F.when(F.size(verdict.lines_removed) > 0, without_lines(F.col("text"), verdict.lines_removed)).otherwise(F.col("text"))
    judged_docs = docs.join(joinable(verdicts, f"{name}.lines_removed"), matches, "left")
    return with_text(judged_docs.where(F.coalesce(verdict.kept, F.lit(True))), text, docs).select(*docs.columns)


def with_text(df: DataFrame, text, docs: DataFrame) -> DataFrame:
    df = df.withColumn("text", text)
    return df.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else df
