"""Benchmark passages in training texts, by a positional inverted index.

The index holds a posting (term, document, position) for every training word
that a benchmark item uses. For each window of an item the posting lists of its
rarest terms are shifted by the terms' places in the item; where they meet, the
window may stand, and the words of the document there decide. Only built-in
functions of Spark are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import LOWER, UPPER, same, stored, text_key, unused

# What stands between words, whether or not A-Z are lowered: ASCII but digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 1_000_000  # 16 bytes each
BROADCAST_CHARACTERS = 32 * 1024 * 1024  # items with more text than this are joined by shuffles


@dataclass(frozen=True)
class Rule:
    """Windows of ``window`` words; ``lists`` rarest terms of each are intersected.

    Terms are near when ``slop`` words more or less than in the item lie between
    them. A document is contaminated if at least 1 in ``one_in`` of its words is hit.
    """

    window: int = 13
    lists: int = 2
    slop: int = 8
    one_in: int = 20


def _lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _words(text: Column) -> Column:
    """The words of a text, in the case they have; none of null. Splitting is faster than extracting."""
    return F.coalesce(F.array_remove(F.split(text, BETWEEN), ""), F.array().cast("array<string>"))


def benchmark_items(benchmark: DataFrame, rule: Rule, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """The distinct items with words: item, item_id as text, words and width of a window."""
    words = _words(_lowered(F.col(text_column)))
    return (
        benchmark.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item_id"), words.alias("words"))
        .where(F.size("words") > 0)
        .distinct()
        .withColumn("item", F.xxhash64("item_id", "words"))
        .withColumn("width", F.least(F.size("words"), F.lit(rule.window)))
    )


def _small(df: DataFrame, bounded: bool) -> DataFrame:
    return F.broadcast(df) if bounded else df


def build_index(docs: DataFrame, items: DataFrame, bounded: bool, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Postings of the items' terms: doc_id, text_hash, term, position.

    Each row of ``docs`` also has one posting of the empty term, after its words, so that
    its position is their number.
    """
    text = F.col(text_column)
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        text_key(text).alias("text_hash"),
        _words(text).alias("words"),
    )
    each = rows.select("doc_id", "text_hash", F.posexplode(F.concat("words", F.array(F.lit("")))).alias("position", "word"))
    terms = items.select(F.explode("words").alias("term")).distinct()
    terms = terms.union(terms.sparkSession.range(1).select(F.lit("")))
    # Lower case first: cheap, and equal wherever the words are equal with A-Z lowered.
    vocabulary = terms.select(F.lower("term").alias("any_case"), "term")
    is_term = (F.col("word") == F.col("term")) | (_lowered(F.col("word")) == F.col("term"))
    found = each.join(_small(vocabulary, bounded), (F.lower("word") == F.col("any_case")) & is_term)
    return found.select("doc_id", "text_hash", "term", "position")


def rarest_terms(items: DataFrame, index: DataFrame, rule: Rule) -> DataFrame:
    """The items with ``windows``: for each window whose terms all occur, the places of its rarest terms."""
    counts = index.where("term != ''").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    each = items.select("item", F.posexplode("words").alias("place", "term"))
    per_item = (
        each.join(counts, "term", "left")
        .groupBy("item")
        .agg(F.array_sort(F.collect_list(F.struct("place", F.coalesce("n", F.lit(0)).alias("n")))).alias("places"))
    )

    def rarest(start: Column) -> Column:
        window = F.slice("places", start + 1, F.col("width"))
        return F.array_sort(F.transform(window, lambda x: F.struct(x.n.alias("n"), x.place.alias("place"))))

    starts = F.sequence(F.lit(0), F.size("words") - F.col("width"))
    present = F.filter(F.transform(starts, rarest), lambda window: window[0].n > 0)
    windows = F.transform(present, lambda w: F.transform(F.slice(w, 1, rule.lists), lambda x: x.place))
    return items.join(per_item, "item").select("item", "item_id", "words", "width", windows.alias("windows"))


def shifted_postings(items: DataFrame, index: DataFrame, bounded: bool) -> DataFrame:
    """The postings of the rarest terms, each with where the item would begin in the document."""
    places = items.select("item", "words", F.explode(F.array_distinct(F.flatten("windows"))).alias("place"))
    wanted = places.select("item", "place", F.get("words", F.col("place")).alias("term"))
    return index.join(_small(wanted, bounded), "term").select(
        "doc_id", "text_hash", "item", "place", (F.col("position") - F.col("place")).alias("begin")
    )


def _covered(hits: DataFrame, items: DataFrame, bounded: bool, *by: str) -> DataFrame:
    """The groups of postings in which all the rarest terms of some window are found."""
    groups = hits.groupBy("doc_id", "text_hash", "item", *by).agg(F.collect_set("place").alias("found"))
    whole = F.exists("windows", lambda window: F.size(F.array_except(window, F.col("found"))) == 0)
    return groups.join(_small(items, bounded), "item").where(whole).drop("windows", "found")


def phrase_matches(docs: DataFrame, candidates: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with an exact window: the positions hit and the items.

    A document's candidates are compared with its words in one pass over them. It has each item once, with all its beginnings.
    """
    key = ["doc_id", "text_hash"]
    item = [F.first(name).alias(name) for name in ("item_id", "words", "width")]
    per_item = candidates.groupBy(*key, "item").agg(*item, F.collect_list("begin").alias("begins"))
    each = F.struct("item_id", "words", "width", "begins")
    wanted = stored(per_item.groupBy(*key).agg(F.collect_list(each).alias("candidates")), "candidates")
    text = F.col(text_column)
    rows = docs.select(F.col(id_column).cast("long").alias("d"), text_key(text).alias("h"), text.alias("text"))
    matches = same(F.col("d"), F.col("doc_id")) & (F.col("h") == F.col("text_hash"))
    if wanted.count() <= BROADCAST_ROWS:
        rows = rows.join(F.broadcast(wanted.select("doc_id", "text_hash")), matches, "left_semi")
    both = rows.join(wanted.hint("shuffle_hash"), matches)

    def places(words: Column, c: Column, begin: Column) -> Column:
        """The positions hit by the exact windows of an item that begins here."""
        there = F.transform(c.words, lambda word, place: F.coalesce(F.get(words, begin + place) == word, F.lit(False)))

        def hit(there: Column) -> Column:
            starts = F.sequence(F.lit(0), F.size(there) - c.width)
            exact = F.filter(starts, lambda start: ~F.array_contains(F.slice(there, start + 1, c.width), False))
            return F.flatten(F.transform(exact, lambda s: F.sequence(begin + s, begin + s + c.width - 1)))

        return F.get(F.transform(F.array(there), hit), F.lit(0))

    def found(words: Column, c: Column) -> Column:
        hits = F.transform(c.begins, lambda begin: places(words, c, begin))
        return F.struct(c.item_id.alias("item_id"), F.array_distinct(F.flatten(hits)).alias("places"))

    def all_found(words: Column) -> Column:
        return F.filter(F.transform("candidates", lambda c: found(words, c)), lambda m: F.size(m.places) > 0)

    # The words and what is there are arguments, as columns of them would be made anew for each place they are asked for.
    words = _words(_lowered(F.col("text")))
    return (
        both.select("doc_id", "text_hash", F.get(F.transform(F.array(words), all_found), F.lit(0)).alias("matches"))
        .where(F.size("matches") > 0)
        .select(
            "doc_id",
            "text_hash",
            F.array_distinct(F.flatten("matches.places")).alias("places"),
            F.array_sort(F.array_distinct("matches.item_id")).alias("items"),
        )
        .dropDuplicates(["doc_id", "text_hash"])
    )


def near_items(hits: DataFrame, items: DataFrame, rule: Rule, bounded: bool) -> DataFrame:
    """The items of which a window's rarest terms stand near each other, in a stretch of 2 * slop shifts."""
    stretch = F.floor(F.col("begin") / F.lit(rule.slop))
    twice = hits.withColumn("stretch", F.explode(F.array(stretch, stretch + 1)))
    near = _covered(twice, items, bounded, "stretch").groupBy("doc_id", "text_hash")
    return near.agg(F.count_distinct("item_id").alias("n_near"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, rule: Rule = Rule(), **columns: str) -> DataFrame:
    """One row per row of ``docs``: words, words hit, items found exactly and nearly, and the verdict.

    Null and empty texts have no words and are clean. Items without words are left
    out, items with fewer words than a window are one window. Rows with the same id and text get
    the same result; a null id is an id of its own; items of one id count once.
    Without items nothing is hit. Other columns are not read.
    """
    size = benchmark.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    bounded = size <= BROADCAST_CHARACTERS
    items = benchmark_items(benchmark, rule)
    index = stored(build_index(docs, items, bounded, **columns), "postings")
    items = stored(rarest_terms(items, index, rule), "rarest")
    hits = shifted_postings(items, index, bounded)
    candidates = _covered(hits, items, bounded, "begin")
    exact = phrase_matches(docs, candidates, **columns)
    near = near_items(hits, items, rule, bounded)
    rows = index.where("term = ''").select("doc_id", "text_hash", F.col("position").cast("long").alias("n_words"))

    def keyed(df: DataFrame, tag: str) -> tuple[DataFrame, Column]:
        df = df.withColumnsRenamed({"doc_id": f"{tag}_id", "text_hash": f"{tag}_hash"})
        return df, same(F.col("doc_id"), F.col(f"{tag}_id")) & (F.col("text_hash") == F.col(f"{tag}_hash"))

    exact, on_exact = keyed(exact, "exact")
    near, on_near = keyed(near, "near")
    n_hit = F.coalesce(F.size("places"), F.lit(0)).cast("long")
    no_items = F.array().cast("array<string>")
    return (
        rows.join(exact, on_exact, "left")
        .join(near, on_near, "left")
        .select(
            "doc_id",
            "text_hash",
            "n_words",
            F.when(F.col("places").isNull(), F.lit(0)).otherwise(n_hit).cast("long").alias("n_hit"),
            F.coalesce("items", no_items).alias("items"),
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        )
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * rule.one_in >= F.col("n_words")))
    )


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
        "n_near",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns as they were."""
    bad = find_contamination(docs, benchmark, rule).where("contaminated")
    name = unused(docs, "_found_")
    bad = bad.select(F.struct(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).alias(name)).distinct()
    found = F.col(name)
    matches = same(F.col("doc_id").cast("long"), found.id) & (text_key(F.col("text")) == found.hash)
    return docs.join(bad, matches, "left_anti")
