import collections
import random

import plain
import pytest

from tributary.llm import quality
from tributary.llm.common import table
from tributary.llm.quality import LineLimits

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def verdicts(docs, limits):
    """By (doc_id, host, text): the base counts, words_removed, kept and the text that is left."""
    hosts, holders = collections.defaultdict(set), collections.defaultdict(set)
    for doc_id, host, text in docs:
        hosts[host].add(doc_id)
        for line in (text or "").split("\n"):
            if plain.parts(line):
                holders[host, " ".join(plain.parts(line))].add(doc_id)
    often = {
        (host, line)
        for (host, line), ids in holders.items()
        if len(ids) > limits.min_documents and len(ids) > limits.share * len(hosts[host])
    }
    out = {}
    for doc_id, host, text in docs:
        base = plain.quality(text)
        lines = (text or "").split("\n")
        gone = [i for i, line in enumerate(lines) if (host, " ".join(plain.parts(line))) in often]
        removed = sum(len(plain.parts(lines[i])) for i in gone)
        left = base[0] - removed
        depleted = removed > 0 and (left < limits.min_words or left < base[0] * limits.min_left)
        text = "\n".join(line for i, line in enumerate(lines) if i not in gone) if gone else text
        out[doc_id, host] = (*base, removed, not base[-1] and not depleted, text)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_counting_by_hand(spark, seed):
    rng = random.Random(seed)
    menu = [plain.sentence(rng, n) for n in (2, 4, 6, 8)]
    docs = []
    for i in range(120):
        text = [plain.sentence(rng, rng.randrange(1, 20), 30) for _ in range(rng.randrange(6))]
        text += [rng.choice([m, m.upper(), f"  {m} "]) for m in menu if rng.random() < 0.3]
        rng.shuffle(text)
        docs.append((i, f"h{i % 3}", "\n".join(text) + rng.choice(["", "\n", "#* é $"])))
    limits = LineLimits(min_documents=5, share=0.2)
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").repartition(4)
    want = verdicts(docs, limits)
    got = quality.judge_documents(df, limits).collect()
    assert {r["doc_id"]: (*(r[c] for c in BASE), r["words_removed"], r["kept"]) for r in got} == {i: v[:-1] for (i, _), v in want.items()}
    assert any(v[-2] and v[-3] for v in want.values()) and any(not v[-2] and not v[5] for v in want.values())
    kept = {r["doc_id"]: r["text"] for r in quality.keep_good(df, limits).collect()}
    assert kept == {i: v[-1] for (i, _), v in want.items() if v[-2]}


def test_counts_of_a_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = {r["doc_id"]: tuple(r[c] for c in BASE) for r in quality.judge_documents(docs).collect()}
    assert got == {r["doc_id"]: plain.quality(r["text"]) for r in docs.collect()}


def test_repeated_windows_with_many_words():
    rng = random.Random(3)
    for n in (0, 4, 5, 6, 50, 9000):
        for vocabulary in (2, 60, 8000):
            text = plain.sentence(rng, n, vocabulary)
            assert quality.repeat_words(text.encode().split()) == plain.quality(text)[4]


def test_rows_that_are_odd(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [
        (1, "h", good, 5, "x"), (1, "h", good, 5, "x"), (1, "h", good + " more", 5, "x"), (None, None, good, None, None),
        (None, None, good, None, None), (2, None, None, None, None), (3, "h", "", 0, ""), (4, "h", "\x1f \x85  " + good, 1, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, n_chars long, hash string")
    got = sorted(((r["doc_id"], r["n_words"], r["kept"]) for r in quality.judge_documents(docs).collect()), key=repr)
    assert got == sorted([(1, 30, True), (1, 30, True), (1, 31, True), (None, 30, True), (None, 30, True), (2, 0, False), (3, 0, False), (4, 32, True)], key=repr)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == 6
    assert quality.judge_documents(docs.limit(0)).count() == 0
    assert quality.keep_good(docs.limit(0)).count() == 0
