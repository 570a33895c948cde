"""Lines that a later document shares with an earlier one, found by aligning the two.

Documents meet through lines that are rare in the corpus: of every run of lines with enough words, each as short as may be,
the rarest lines that several documents have, and the run itself. Each holder is paired with the earliest,
so that pairs are no more than such lines and runs, however many documents hold one. A pair is
aligned by patience diff: lines that both have once, in the longest common
order, are anchors, and what lies between them is aligned in turn. A stretch of aligned
lines with small gaps, such as an edited line leaves, is a block, and with enough words it is deleted from the later document. Of
the lines left, those in shared runs that no alignment in one order finds, as they repeat or have moved, go in the same way: every
occurrence in the later document is paired with the first in the earlier.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import ASCII_LOWER, joinable, mapped, small, stored, text_key, unused, without_lines, words_at


@dataclass(frozen=True)
class Blocks:
    """Blocks of at least ``min_words`` words are deleted, and with them gaps of up to ``gap`` lines.

    Documents meet through the ``rarest`` lines of every run that may be deleted.
    """

    min_words: int = 30
    gap: int = 1
    rarest: int = 2


@dataclass(frozen=True)
class Remains:
    """A document goes if a deletion leaves fewer words than this, or a smaller part of them."""

    min_words: int = 10
    min_left: float = 0.4


PAIRS = 256  # documents aligned with one earlier document in one group


def short_runs(words: Sequence[int], min_words: int) -> set[tuple[int, int]]:
    """The runs of lines with enough words that have none without their first, or without their last, line.

    Every line with words of a longer run is in one of those inside it.
    """
    out, start, total = set(), 0, 0
    for end, count in enumerate(words):
        total += count
        while total - words[start] >= min_words:
            total -= words[start]
            start += 1
        if total >= min_words and count and words[start]:
            out.add((start, end + 1))
    end, total = len(words), 0
    for start in range(len(words) - 1, -1, -1):
        total += words[start]
        while total - words[end - 1] >= min_words:
            end -= 1
            total -= words[end]
        if total >= min_words and words[start] and words[end - 1]:
            out.add((start, end))
    return out


def line_batches(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """doc_id, text_hash, text -> doc_id, text_hash, hash and number of words of each line, hashes of its short runs.

    A line without words has hash 0 and is in no run: those around it are next to each other.
    """
    for batch in batches:
        hashes: list[int] = []
        sizes: list[int] = []
        runs: list[list[int]] = []
        ends = [0]
        for scalar in batch.column(2):
            for line in (scalar.as_py() or "").encode().split(b"\n"):
                words = line.split()
                sizes.append(len(words))
                joined = b" ".join(words).translate(ASCII_LOWER)
                hashes.append(xxhash.xxh3_64_intdigest(joined) - 2**63 if words else 0)
            own = array("q", [line for line, size in zip(hashes[ends[-1] :], sizes[ends[-1] :], strict=True) if size])
            found = short_runs([size for size in sizes[ends[-1] :] if size], min_words)
            runs.append(sorted({xxhash.xxh3_64_intdigest(own[start:end].tobytes()) - 2**63 for start, end in found}))
            ends.append(len(hashes))
        offsets = pa.array(ends, pa.int32())
        columns = [
            pa.ListArray.from_arrays(offsets, pa.array(hashes, pa.int64())),
            pa.ListArray.from_arrays(offsets, pa.array(sizes, pa.int32())),
            pa.array(runs, pa.list_(pa.int64())),
        ]
        names = ["doc_id", "text_hash", "lines", "words", "runs"]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=names)


def _increasing(values: list[int]) -> list[int]:
    """The indices of a longest increasing subsequence."""
    tails: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for index, value in enumerate(values):
        place = bisect_left(tails, value)
        before.append(at[place - 1] if place else -1)
        if place == len(tails):
            tails.append(value)
            at.append(index)
        else:
            tails[place], at[place] = value, index
    out, index = [], at[-1] if at else -1
    while index >= 0:
        out.append(index)
        index = before[index]
    return out[::-1]


def aligned(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """The places of ``a`` and ``b`` that patience diff aligns, in order."""
    out: list[tuple[int, int]] = []
    ranges = [(0, len(a), 0, len(b))]
    while ranges:
        a0, a1, b0, b1 = ranges.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        times_a, times_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {line: i for i, line in enumerate(b[b0:b1], b0) if times_b[line] == 1}
        both = [(i, place[line]) for i, line in enumerate(a[a0:a1], a0) if times_a[line] == 1 and line in place]
        anchors = [both[i] for i in _increasing([j for _, j in both])]
        if not anchors:
            continue
        out += anchors
        corners = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        ranges += [
            (i + 1, k, j + 1, m) for (i, j), (k, m) in zip(corners, corners[1:], strict=False) if i + 1 < k and j + 1 < m
        ]
    return sorted(out)


def _runs_of(lines: Sequence[int], other: set[int], sizes: dict[int, int], min_words: int) -> Iterator[tuple[int, int]]:
    """The short runs of ``lines`` that have only lines of ``other``."""
    for shared, group in groupby(range(len(lines)), lambda i: lines[i] in other):
        if shared:
            places = list(group)
            for start, end in short_runs([sizes[lines[i]] for i in places], min_words):
                yield places[0] + start, places[0] + end


def shared_runs(a: Sequence[int], b: Sequence[int], words: Sequence[int], min_words: int, gone: set[int]) -> set[int]:
    """The places in ``a`` of short runs that ``b`` has too, wherever and however often; those all in ``gone`` are left out."""
    sizes = dict(zip(a, words, strict=True))
    wanted: dict[tuple[int, ...], list[tuple[int, int]]] = {}
    for start, end in _runs_of(a, set(b), sizes, min_words):
        if not gone.issuperset(range(start, end)):
            wanted.setdefault(tuple(a[start:end]), []).append((start, end))
    out: set[int] = set()
    if wanted:
        for start, end in _runs_of(b, set(a), sizes, min_words):
            for first, last in wanted.pop(tuple(b[start:end]), ()):
                out.update(range(first, last))
    return out


def stretches(pairs: Sequence[tuple[int, int]], words: Sequence[int], rule: Blocks) -> set[int]:
    """The places of blocks: aligned pairs with small gaps, such as edited lines leave, and enough aligned words.

    A gap has as many lines on either side, at most ``gap``, and fewer words than a block.
    """
    gone: set[int] = set()
    block: list[int] = []
    other = -1
    for i, j in pairs:
        between = range(block[-1] + 1, i) if block else ()
        apart = len(between) > rule.gap or len(between) != j - other - 1
        if block and (apart or sum(words[k] for k in between) >= rule.min_words):
            gone |= _whole(block, words, rule)
            block = []
        block.append(i)
        other = j
    return gone | _whole(block, words, rule)


def _whole(block: list[int], words: Sequence[int], rule: Blocks) -> set[int]:
    enough = sum(words[k] for k in block) >= rule.min_words
    return set(range(block[0], block[-1] + 1)) if block and enough else set()


def common_blocks(a: Sequence[int], b: Sequence[int], words: Sequence[int], rule: Blocks) -> list[int]:
    """The places in ``a`` of blocks it has in common with ``b``, and of runs with enough words in any order and number.

    Lines without words, which are 0 or empty, are set aside first. They go where the lines with words next to them all go.
    """
    size = len(words)
    at = [i for i, count in enumerate(words) if count]
    a, b, words = [a[i] for i in at], [line for line in b if line], [words[i] for i in at]
    gone = stretches(aligned(a, b), words, rule)
    if len(gone) < len(a):
        gone |= shared_runs(a, b, words, rule.min_words, gone)
    if not gone:
        return []
    out = [at[k] for k in gone]
    at, gone = [-1, *at, size], {0, len(at) + 1, *(k + 1 for k in gone)}
    for k in range(1, len(at)):
        if k - 1 in gone and k in gone:
            out += range(at[k - 1] + 1, at[k])
    return sorted(out)


def align_batches(batches: Iterator[pa.RecordBatch], rule: Blocks) -> Iterator[pa.RecordBatch]:
    """group, earlier, side, doc, lines, words in the order of groups, the earlier document (side 0) first -> doc, places to delete.

    Pairs without any are left out.
    """
    of, earlier = None, []
    for batch in batches:
        kept, places = [], []
        lines, words = batch.column(4), batch.column(5)
        for row, (group, name, side) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)):
            if side == 0:
                of, earlier = (group, name), lines[row].values.to_pylist()
                continue
            if of != (group, name):
                raise ValueError(f"the lines of {name} are missing")
            found = common_blocks(lines[row].values.to_pylist(), earlier, words[row].values.to_pylist(), rule)
            if found:
                kept.append(row)
                places.append(found)
        if kept:
            columns = [batch.column(3).take(pa.array(kept)), pa.array(places, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "places"])


def rarest_batches(batches: Iterator[pa.RecordBatch], rule: Blocks) -> Iterator[pa.RecordBatch]:
    """doc, lines, words, shared (line, documents) -> doc, line: the rarest shared lines of its short runs."""
    for batch in batches:
        docs, found = [], []
        for row in range(batch.num_rows):
            words = batch.column(2)[row].values.to_pylist()
            lines = [line for line, size in zip(batch.column(1)[row].values.to_pylist(), words, strict=True) if size]
            times = {each["line"]: each["documents"] for each in batch.column(3)[row].as_py()}
            own: set[int] = set()
            for start, end in short_runs([size for size in words if size], rule.min_words):
                shared = {(times[line], line) for line in lines[start:end] if line in times}
                own.update(line for _, line in sorted(shared)[: rule.rarest])
            docs += [row] * len(own)
            found += own
        if docs:
            columns = [batch.column(0).take(pa.array(docs)), pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "line"])


DOC = "struct<unknown: boolean, id: long, hash: long>"


def _doc(id_column: Column, text: Column) -> Column:
    """A document's key; keys compare in the order of documents, those without an id last."""
    known = id_column.cast("long")
    return F.struct(known.isNull().alias("unknown"), known.alias("id"), text_key(text).alias("hash"))


def _with_earliest(held: DataFrame, by: str) -> DataFrame:
    """Each holder of what ``by`` names with the earliest one; the earliest are stored, so that the join can split a hot one."""
    shared = held.groupBy(by).agg(F.min("doc").alias("earlier"), F.max("doc").alias("last")).where("earlier != last")
    shared = stored(shared.select(by, "earlier"), "shared")
    return held.join(shared, by).where("doc != earlier").select("doc", "earlier")


def rare_lines(lines: DataFrame, rule: Blocks) -> DataFrame:
    """doc and line: the rarest of the lines in its runs that several documents have, counted over all."""
    each = lines.select("doc", F.explode(F.array_distinct("lines")).alias("line")).where("line != 0")
    counts = stored(each.groupBy("line").agg(F.count(F.lit(1)).alias("documents")).where("documents > 1"), "counts")
    shared = each.join(counts, "line").groupBy("doc").agg(F.collect_list(F.struct("line", "documents")).alias("shared"))
    worded = lines.where(F.size("runs") > 0).select("doc", "lines", "words")
    return mapped(worded.join(shared, "doc"), rarest_batches, f"doc {DOC}, line long", rule)


def overlapping(lines: DataFrame, rule: Blocks) -> DataFrame:
    """The pairs of documents to align: doc and earlier, the first to hold one of its runs or of its rare lines."""
    runs = _with_earliest(lines.select("doc", F.explode("runs").alias("run")), "run")
    rare = _with_earliest(stored(rare_lines(lines, rule), "rare"), "line")
    return runs.union(rare).distinct()


def shared_blocks(docs: DataFrame, rule: Blocks = Blocks(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc and the places of its lines to delete, for the documents that have any.

    The lines of an earlier document are moved once for ``PAIRS`` later ones.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), text_key(F.col(text_column)).alias("text_hash"), F.col(text_column).alias("text")
    )
    schema = "doc_id long, text_hash long, lines array<long>, words array<int>, runs array<long>"
    lines = mapped(rows, line_batches, schema, rule.min_words)
    doc = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    lines = stored(lines.select(doc.alias("doc"), "lines", "words", "runs").dropDuplicates(["doc"]), "lines")
    pairs = stored(overlapping(lines, rule), "pairs")
    many = pairs.groupBy("earlier").agg(F.ceil(F.count(F.lit(1)) / PAIRS).cast("int").alias("parts")).where("parts > 1")
    part = F.pmod(F.xxhash64("doc"), F.coalesce("parts", F.lit(1)))
    dealt = pairs.join(small(stored(many, "many")), "earlier", "left")
    dealt = dealt.select(F.xxhash64("earlier", part).alias("group"), "earlier", F.lit(1).alias("side"), "doc")
    earlier = dealt.select("group", "earlier", F.lit(0).alias("side"), F.col("earlier").alias("doc")).distinct()
    both = dealt.union(earlier).join(lines.select("doc", "lines", "words"), "doc")
    both = both.select("group", "earlier", "side", "doc", "lines", "words")
    ordered = both.repartition("group").sortWithinPartitions("group", "earlier", "side")
    found = mapped(ordered, align_batches, f"doc {DOC}, places array<int>", rule)
    return found.groupBy("doc").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"))


def _marked(docs: DataFrame, name: str, rule: Blocks, id_column: str, text_column: str) -> DataFrame:
    """``docs`` and a struct ``name``: the text left, lines and words removed; null where nothing is deleted."""
    found = shared_blocks(docs, rule, id_column, text_column).select(F.struct("doc", "places").alias(name))
    found = stored(found, "found")
    marked, text = F.col(name), F.col(text_column)
    joined = docs.join(joinable(found, f"{name}.places"), marked.doc == _doc(F.col(id_column), text), "left")
    # In a column of its own, as within a lambda a new column of the text's name would be taken for the text.
    what = F.struct(
        without_lines(text, marked.places).alias("text"),
        F.size(marked.places).alias("lines"),
        words_at(text, marked.places).alias("words"),
    )
    return joined.withColumn(name, F.when(marked.isNotNull(), what))


def dedupe_lines(docs: DataFrame, rule: Blocks = Blocks(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the shared blocks deleted from the text, and ``lines_removed``, ``words_removed``, in place of columns of these names.

    Earlier is what has the smaller id; a null id comes last, equal ids go by a
    hash of their texts. Rows with the same id and text are one document and never
    lose lines to each other. A null text stays null, an empty one empty. Lines are compared by
    their words, A-Z lowered; lines without words are set aside, and go where all lines with words
    next to them go.
    """
    name = unused(docs, "_found_")
    joined, found = _marked(docs, name, rule, id_column, text_column), F.col(name)
    counts = {"lines_removed": found.lines, "words_removed": found.words}
    text = F.when(found.isNull(), F.col(text_column)).otherwise(found.text).alias(text_column)
    return joined.select(
        *(text if c == text_column else c for c in docs.columns if c.lower() not in counts),
        *(F.coalesce(count, F.lit(0)).alias(c) for c, count in counts.items()),
    )


def drop_shared_lines(docs: DataFrame, rule: Blocks = Blocks(), remains: Remains = Remains()) -> DataFrame:
    """The documents without their shared blocks, less those of which a deletion leaves too little.

    The columns of ``docs`` as they were; ``n_chars``, where there is one, follows the text.
    """
    name = unused(docs, "_found_")
    joined, found = _marked(docs, name, rule, "doc_id", "text"), F.col(name)
    words = F.size(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    enough = (words - found.words >= remains.min_words) & (words - found.words >= words * remains.min_left)
    kept = joined.where(found.isNull() | enough)
    columns = {"text": F.when(found.isNull(), F.col("text")).otherwise(found.text)}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(found.isNull(), F.col("n_chars")).otherwise(F.length(found.text)).cast(docs.schema["n_chars"].dataType)
    return kept.select(*(columns[c].alias(c) if c in columns else c for c in docs.columns))
