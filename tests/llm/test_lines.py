import collections
import itertools
import random

import plain
import pytest
import xxhash

from tributary.llm import common, lines
from tributary.llm.lines import Blocks


def longest_common(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_alignments_are_ordered_and_equal():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.randrange(12) for _ in range(rng.randrange(15))]
        b = [rng.randrange(12) for _ in range(rng.randrange(15))]
        pairs = lines.aligned(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in itertools.pairwise(pairs))
        assert len(pairs) <= longest_common(a, b)


def test_lines_without_repeats_align_as_far_as_possible():
    rng = random.Random(2)
    for _ in range(200):
        a, b = (rng.sample(range(14), rng.randrange(14)) for _ in range(2))
        assert len(lines.aligned(a, b)) == longest_common(a, b)


def shortest(words, least):
    """Of all runs with enough words those that lose them without either their first or their last line."""
    out = set()
    for start, end in itertools.combinations(range(len(words) + 1), 2):
        total = sum(words[start:end])
        if total >= least and words[start] and words[end - 1]:
            if total - words[start] < least or total - words[end - 1] < least:
                out.add((start, end))
    return out


def test_every_line_of_a_long_run_is_in_a_short_one():
    rng = random.Random(4)
    for _ in range(300):
        words, least = [rng.choice([0, 1, 2, 3, 7]) for _ in range(rng.randrange(12))], rng.randrange(1, 9)
        short = lines.short_runs(words, least)
        assert short <= shortest(words, least)
        for start, end in itertools.combinations(range(len(words) + 1), 2):
            if sum(words[start:end]) >= least and words[start] and words[end - 1]:
                inside = {k for a, b in short if start <= a and b <= end for k in range(a, b)}
                assert {k for k in range(start, end) if words[k]} <= inside


def key(line):
    return xxhash.xxh3_64_intdigest(line.encode()) - 2**63


def stretch_lines(a, b, rule):
    """The lines of ``a`` in blocks shared with ``b``; all lines are distinct and in one order, so that there is one alignment."""
    pairs = [(i, b.index(line)) for i, line in enumerate(a) if line in b]
    assert pairs == sorted(pairs, key=lambda p: p[1])
    words = [len(line.split()) for line in a]
    out = set()
    for x, y in itertools.combinations(range(len(pairs) + 1), 2):
        part = pairs[x:y]
        near = all(
            k - i == m - j <= rule.gap + 1 and sum(words[i + 1 : k]) < rule.min_words
            for (i, j), (k, m) in itertools.pairwise(part)
        )
        if near and sum(words[i] for i, _ in part) >= rule.min_words:
            out.update(range(part[0][0], part[-1][0] + 1))
    return out


def expected(docs, rule):
    """Every later document against the earliest holder of each run of its lines with enough words, and of each line that is rare in one."""
    split = [[" ".join(plain.parts(line)) for line in (text or "").split("\n")] for _, text in docs]
    worded = [[line for line in lines if line] for lines in split]
    order = sorted(range(len(docs)), key=lambda i: docs[i][0])
    documents = collections.Counter(line for lines in worded for line in set(lines))
    first, out = {}, {}
    for i in order:
        met = set()
        sizes = [len(line.split()) for line in worded[i]]
        for start, end in itertools.combinations(range(len(sizes) + 1), 2):
            if sum(sizes[start:end]) >= rule.min_words:
                met.add(tuple(worded[i][start:end]))
        for start, end in shortest(sizes, rule.min_words):
            rare = sorted((documents[line], key(line), line) for line in set(worded[i][start:end]) if documents[line] > 1)
            met.update(line for _, _, line in rare[: rule.rarest])
        partners = {first.setdefault(each, i) for each in met} - {i}
        gone = set()
        for p in partners:
            gone |= stretch_lines(worded[i], worded[p], rule) | run_lines(worded[i], worded[p], rule.min_words)
        number = [k for k, line in enumerate(split[i]) if line]
        lost = {number[k] for k in gone}
        kept = [line for k, line in enumerate((docs[i][1] or "").split("\n")) if k not in lost]
        out[docs[i][0]] = "\n".join(kept), len(lost)
    return out


def in_order(seed, n, edited):
    """Documents of distinct lines in one order, with passages of which some lines are edited."""
    rng = random.Random(seed)
    pool = [plain.sentence(rng, rng.randrange(1, 14)) for _ in range(40)]
    passages = [[plain.sentence(rng, 15) for _ in range(6)] for _ in range(4)]
    docs = []
    for i in range(n):
        text = [plain.sentence(rng, 9)] + [pool[k] for k in sorted(rng.sample(range(40), rng.randrange(1, 8)))]
        for passage in passages:
            if rng.random() < 0.3:
                text += [plain.sentence(rng, rng.choice([3, 40]))]
                text += [line if rng.random() > edited else plain.sentence(rng, 15) for line in passage]
        docs.append((i, "\n".join(text)))
    return docs


@pytest.mark.parametrize(("seed", "edited"), [(1, 0.0), (2, 0.2)])
def test_agrees_with_comparing_all_holders(spark, seed, edited):
    docs, rule = in_order(seed, 80, edited), Blocks(min_words=20)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["text"], r["lines_removed"]) for r in lines.dedupe_lines(df, rule).collect()}
    want = expected(docs, rule)
    assert got == want
    assert sum(n for _, n in want.values()) > 100


def test_a_passage_with_an_edited_line_goes_whole_by_the_alignment(spark, monkeypatch):
    rng = random.Random(8)
    passage = [plain.sentence(rng, 9) for _ in range(7)]
    edit = [*passage[:3], plain.sentence(rng, 8), *passage[4:]]  # 27 words on either side, so that no run has 30
    own = [plain.sentence(rng, 12) for _ in range(4)]
    a, b = [own[0], *edit, own[1]], [own[2], *passage, own[3]]
    words = [len(line.split()) for line in a]
    assert lines.common_blocks(a, b, words, Blocks()) == list(range(1, 8))
    assert lines.common_blocks(a, b, words, Blocks(gap=0)) == []
    docs = spark.createDataFrame([(1, "\n".join(b)), (2, "\n".join(a))], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in lines.dedupe_lines(docs).collect()}
    assert got == {1: "\n".join(b), 2: f"{own[0]}\n{own[1]}"}
    monkeypatch.setattr(lines, "aligned", lambda a, b: [])
    assert lines.common_blocks(a, b, words, Blocks()) == []


def test_a_hot_passage_is_dealt_over_groups(spark, monkeypatch):
    monkeypatch.setattr(lines, "PAIRS", 10)
    rng = random.Random(9)
    passage = "\n".join(plain.sentence(rng, 13) for _ in range(4))
    docs = [(i, f"{plain.sentence(rng, 20)}\n{passage}") for i in range(200)]
    ordered = []
    monkeypatch.setattr(lines, "mapped", lambda df, f, *a: ordered.append((f.__name__, df)) or common.mapped(df, f, *a))
    got = lines.dedupe_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r["doc_id"]: r["lines_removed"] for r in got.collect()} == {i: 4 * (i > 0) for i in range(200)}
    dealt = [df for name, df in ordered if name == "align_batches"][0].groupBy("group", "side").count().collect()
    sizes = {side: [r["count"] for r in dealt if r["side"] == side] for side in (0, 1)}
    assert sizes[0] == [1] * len(sizes[1]) and sum(sizes[1]) == 199 and len(sizes[1]) == 20 and max(sizes[1]) < 25


def test_long_passages_are_left_in_the_first_document_only(spark):
    rng = random.Random(3)
    passage = "\n".join(plain.sentence(rng, 13) for _ in range(4))
    own = [plain.sentence(rng, 40) for _ in range(30)]
    docs = spark.createDataFrame([(i, f"{t}\n{passage}\nend {i}") for i, t in enumerate(own)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in lines.drop_shared_lines(docs).collect()}
    assert got == {i: f"{t}\n{passage}\nend {i}" if i == 0 else f"{t}\nend {i}" for i, t in enumerate(own)}


def test_rows_that_are_odd(spark):
    block = "\n".join(["a b c d e f g h i j"] * 4)
    rows = [(1, block, 7, "x"), (1, block, 7, "x"), (2, block, 7, "y"), (None, block, None, None), (3, None, None, None), (4, "", 0, ""), (5, "\n\n", 2, None), (6, "own line", 8, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, lines string")
    got = sorted(((r["doc_id"], r["text"], r["lines_removed"], r["words_removed"]) for r in lines.dedupe_lines(docs).collect()), key=repr)
    want = [(1, block, 0, 0), (1, block, 0, 0), (2, "", 4, 40), (None, "", 4, 40), (3, None, 0, 0), (4, "", 0, 0), (5, "\n\n", 0, 0), (6, "own line", 0, 0)]
    assert got == sorted(want, key=repr)
    kept = lines.drop_shared_lines(docs)
    assert kept.columns == docs.columns
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted([r for r in rows if r[0] not in (2, None)], key=repr)
    assert lines.dedupe_lines(docs.limit(0)).count() == 0


def test_long_documents():
    a = list(range(60_000))
    b = a[:20_000] + [-1] + a[25_000:]
    assert len(lines.aligned(a, b)) == 55_000
    assert len(lines.aligned([1] * 50_000, [1] * 50_000)) == 50_000


def blocks(rng, n, lines_each=5, words=9):
    return [[plain.sentence(rng, words) for _ in range(lines_each)] for _ in range(n)]


def run_lines(a, b, least):
    """The lines of ``a`` in any run with enough words that is somewhere in ``b``, by trying all runs."""
    inside = {tuple(b[i:j]) for i, j in itertools.combinations(range(len(b) + 1), 2)}
    out = set()
    for i, j in itertools.combinations(range(len(a) + 1), 2):
        words = [len(line.split()) for line in a[i:j]]
        if words[0] and words[-1] and sum(words) >= least and tuple(a[i:j]) in inside:
            out.update(range(i, j))
    return out


def test_passages_go_however_often_and_in_whatever_order_they_come(spark):
    rng = random.Random(5)
    p, q, r = blocks(rng, 3)
    own = iter(blocks(rng, 40, 1))
    texts = [
        [*next(own), *p, *next(own), *p, *next(own)],  # the earliest holder has it twice
        [*next(own), *p, *next(own)],
        [*next(own), *p, *next(own), *p, *next(own), *p],
        [*next(own), *q, *next(own), *r, *next(own)],
        [*next(own), *r, *next(own), *q, *next(own)],  # the other order
        [*r, *q, *r, *next(own)],
        [*q[:2], *next(own), *q[2:]],  # too short on both sides of the cut
        [*next(own), *p, *next(own)],
    ]
    docs = [(i, "\n".join(text)) for i, text in enumerate(texts)]
    got = {row["doc_id"]: row["text"].split("\n") for row in lines.dedupe_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    gone = {i: set().union(*(run_lines(text, texts[k], 30) for k in range(i))) for i, text in enumerate(texts)}
    assert got == {i: [line for k, line in enumerate(text) if k not in gone[i]] for i, text in enumerate(texts)}
    assert [len(gone[i]) for i in range(8)] == [0, 5, 15, 0, 10, 15, 0, 5]


def test_all_shared_runs_are_found():
    rng = random.Random(6)
    for _ in range(400):
        pool = [plain.sentence(rng, rng.randrange(1, 5)) for _ in range(rng.randrange(1, 7))]
        a, b = ([rng.choice(pool) for _ in range(rng.randrange(14))] for _ in range(2))
        least = rng.randrange(1, 12)
        words = [len(line.split()) for line in a]
        assert set(lines.common_blocks(a, b, words, Blocks(least, gap=0))) == run_lines(a, b, least)
        assert set(lines.common_blocks(a, b, words, Blocks(least))) >= run_lines(a, b, least)


def test_empty_lines_within_a_passage_do_not_matter(spark):
    rng = random.Random(7)
    passage = [plain.sentence(rng, 8) for _ in range(6)]
    own = [plain.sentence(rng, 7) for _ in range(8)]
    spaced = "\n \n".join(passage)
    docs = [
        (1, "\n".join([own[0], *passage, own[1]])),
        (2, f"{own[2]}\n\n{spaced}\n\n{own[3]}"),
        (3, "\n".join([own[4], *passage[:3], "", "", *passage[3:], own[5]])),
        (4, f"\n{spaced}\n\n"),
        (5, f"{own[6]}\n\n{own[7]}\n" + "\n\n".join(passage[:3])),  # 24 words only
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["lines_removed"], r["words_removed"]) for r in lines.dedupe_lines(df).collect()}
    assert got == {
        1: (docs[0][1], 0, 0),
        2: (f"{own[2]}\n\n\n{own[3]}", 11, 48),
        3: (f"{own[4]}\n{own[5]}", 8, 48),
        4: ("", 14, 48),
        5: (docs[4][1], 0, 0),
    }


def test_documents_of_which_little_is_left_go(spark):
    rng = random.Random(10)
    passage = "\n".join(plain.sentence(rng, 10) for _ in range(5))
    much, little, few = plain.sentence(rng, 34), plain.sentence(rng, 33), plain.sentence(rng, 9)
    rows = [(1, f"first\n{passage}", 0), (2, f"{much}\n{passage}", 0), (3, f"{little}\n{passage}", 0), (4, f"{few}\n{passage}", 0), (5, few, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    kept = {r["doc_id"]: (r["text"], r["n_chars"]) for r in lines.drop_shared_lines(docs).collect()}
    assert kept == {1: (rows[0][1], 0), 2: (much, len(much)), 5: (few, 1)}
