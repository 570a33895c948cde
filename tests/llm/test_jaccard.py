import random

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from tributary.llm import graph, jaccard
from tributary.llm.common import id_of, node_key
from tributary.llm.jaccard import Similarity


def family(rng, size, members, edits):
    base = plain.sentence(rng, size).split()
    out = []
    for _ in range(members):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            at = rng.randrange(len(w))
            w[at : at + rng.randrange(2)] = [f"n{rng.random()}"] * rng.randrange(2)
        out.append(" ".join(w))
    return out


def corpus(seed):
    rng = random.Random(seed)
    texts = []
    for size in (3, 5, 6, 8, 9, 12, 14, 18, 25, 40, 90, 260):
        for _ in range(3):
            texts += family(rng, size, 5, max(1, size // 18))
    passage = plain.sentence(rng, 30)
    texts += [f"{plain.sentence(rng, rng.randrange(1, 25))} {passage} {plain.sentence(rng, rng.randrange(25))}" for _ in range(40)]
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


def check(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.similar_documents(df).collect()), key=repr)
    want = sorted(((d[0], *e) for d, e in zip(docs, plain.similar_groups(docs), strict=True)), key=repr)
    assert got == want


@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_comparing_every_pair(spark, seed):
    check(spark, corpus(seed))


def test_small_blocks_and_shuffled_joins_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    check(spark, corpus(3))


def test_every_similar_pair_shares_a_signature():
    """The guarantee itself, over many sizes and the greatest differences."""
    rng, rule = np.random.default_rng(5), Similarity()
    for size in [*range(4, 60), 75, 113, 170, 256, 400, 1000]:
        for larger in {size, min(size + 1, rule.largest(size)), (size + rule.largest(size)) // 2, rule.largest(size)}:
            for _ in range(6):
                pool = rng.integers(0, 2**63, size=4 * size + 8, dtype=np.uint64)
                most = rule.differences(size + larger)
                shared = (size + larger - most) // 2
                a, b = pool[:size], np.concatenate([pool[:shared], pool[size : size + larger - shared]])
                both = [set(jaccard.signatures(np.sort(x), rule).tolist()) for x in (a, b)]
                assert 100 * shared >= 80 * (size + larger - shared)
                assert most == 0 or both[0] & both[1], (size, larger)


def test_differences_are_the_most_that_are_similar():
    rule = Similarity()
    for a in range(1, 80):
        for b in range(a, rule.largest(a) + 1):
            most = max(a + b - 2 * s for s in range(a + 1) if 100 * s >= 80 * (a + b - s))
            assert rule.differences(a + b) == most


def test_rows_that_are_odd(spark):
    long = plain.sentence(random.Random(6), 30_000)
    docs = [(3, "a b c"), (3, "a b c"), (None, "A b  C"), (4, None), (4, ""), (None, None), (5, " \n\t"), (7, long), (2, long + " x"), (2, "other"), (9, "b")]
    check(spark, docs)
    check(spark, [(None, "only without an id"), (None, "only without an id")])
    assert jaccard.similar_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_one_of_each_group_stays(spark):
    rows = [(5, "a b c", 1), (3, "a b c", 2), (3, "a b c", 2), (None, "a b c", 3), (6, "", 4), (6, "", 4), (7, None, 5), (8, "x", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node long").withColumnRenamed("node", "signature")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted([rows[1], rows[4], rows[4], rows[6], rows[7]], key=repr)


@pytest.mark.parametrize(("seed", "together"), [(1, 10), (2, 25), (3, 250_000)])
def test_components(spark, monkeypatch, seed, together):
    monkeypatch.setattr(graph, "TOGETHER", together)
    rng = random.Random(seed)
    n = 120
    links = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.choice([40, 90]))]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(40)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for link in links if link[0] != link[1] for x in link}
    assert got == plain.joined([link for link in links if link[0] != link[1]], nodes)


def test_no_links(spark):
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_other_keys(spark):
    links = [(b"\x00b", b"\x00a"), (b"\x00c", b"\x00b"), (b"\xff", b"\x01"), (b"\x02", b"\x02")]
    got = {bytes(r["node"]): bytes(r["component"]) for r in graph.components(spark.createDataFrame(links, "a binary, b binary")).collect()}
    assert got == {b"\x00a": b"\x00a", b"\x00b": b"\x00a", b"\x00c": b"\x00a", b"\xff": b"\x01", b"\x01": b"\x01"}


def test_node_keys_compare_as_ids_do(spark):
    ids = [-(2**63), -5, -1, 0, 1, 7, 2**40, 2**63 - 1, None]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    keyed = df.select("id", node_key(F.col("id"), F.lit(b"digest").cast("binary")).alias("key")).repartition(3).orderBy("key")
    assert [(r["id"], r["of"]) for r in keyed.select("id", id_of(F.col("key")).alias("of")).collect()] == [(i, i) for i in ids]


def test_all_candidates_come_from_subsets_of_parts():
    rule = Similarity()
    for low, high in jaccard.bands(rule, 3000):
        plan = jaccard.scheme(rule, low, high)
        assert plan.parts == 0 or (plan.inner > plan.inner - plan.out > 1 and plan.parts * (plan.out + 1) > plan.differences)
