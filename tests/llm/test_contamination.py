import random

import plain
import pytest
from pyspark.sql import functions as F

from tributary.llm import contamination
from tributary.llm.contamination import Rule


def check(spark, docs, items, rule=Rule()):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = contamination.find_contamination(d, b, rule).withColumn("one", F.lit(1)).collect()
    expected = plain.contamination(docs, items, rule.window, rule.one_in)
    want = sorted(((i, *expected[i, t]) for i, t in docs), key=repr)
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"]), r["contaminated"]) for r in got), key=repr) == want
    return got


def planted(rng, items):
    docs = []
    for i in range(60):
        w = plain.sentence(rng, rng.randrange(5, 120), 60).split()
        for _ in range(rng.randrange(3)):
            source = items[rng.randrange(len(items))][1].split()
            start = rng.randrange(len(source))
            at = rng.randrange(len(w) + 1)
            w[at:at] = source[start : start + rng.randrange(4, 30)]
        docs.append((i, "\n".join((" ".join(w[:9]), ", ".join(w[9:]).upper()))))
    return docs


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_agrees_with_comparing_every_window(spark, seed):
    rng = random.Random(seed)
    items = [(i, plain.sentence(rng, rng.choice([3, 13, 14, 40]), 60)) for i in range(12)]
    check(spark, planted(rng, items), items, Rule(window=rng.choice([5, 13])))


def test_rows_that_are_odd(spark):
    item = "Uno dos, TRES quatro"
    docs = [
        (1, "x uno DOS tres: quatro y"),
        (1, "x uno DOS tres: quatro y"),
        (1, "another text"),
        (None, "uno dos tres quatro"),
        (2, None),
        (3, ""),
        (4, "..."),
        (5, "uno dos tres quatro " * 3000),
        (6, "uno dos É quatro"),
        (7, "uno uno dos tres quatro dos tres quatro uno dos"),
    ]
    items = [(1, item), (1, item), (2, item), (None, item), (3, None), (4, ""), (5, "--"), (6, "uno dos é quatro"), (10, "quatro")]
    got = check(spark, docs, items)
    assert sum(r["contaminated"] for r in got) == 6


def test_long_items_that_repeat_are_held_once(spark, monkeypatch):
    rng = random.Random(6)
    item, other = plain.sentence(rng, 60, 500), plain.sentence(rng, 30, 500)
    kept = []
    stored = contamination.stored
    monkeypatch.setattr(contamination, "stored", lambda df, label: kept.append((label, stored(df, label))) or kept[-1][1])
    check(spark, [(1, f"{item} x " * 80 + other), (2, f"{other} {item}")], [(1, item), (2, other)])
    candidates = {r["doc_id"]: r["candidates"] for r in dict(kept)["candidates"].collect()}
    assert sorted(len(c["begins"]) for c in candidates[1]) == [1, 80] and len(candidates[2]) == 2


def test_empty_tables_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", 9, "t")], "doc_id long, text string, items string, position long, term string")
    items = spark.createDataFrame([(1, "a b", "n")], "item_id long, text string, words string")
    assert contamination.find_contamination(docs, items).first()["contaminated"]
    assert contamination.find_contamination(docs.limit(0), items).count() == 0
    assert contamination.find_contamination(docs, items.limit(0)).first()["n_hit"] == 0
    assert contamination.drop_contaminated(docs, items.limit(0)).collect() == docs.collect()
    assert contamination.drop_contaminated(docs, items).columns == docs.columns


def test_near_matches(spark):
    item = " ".join(f"w{i}" for i in range(20))
    near = item.replace("w7 ", "w7 in between ").replace("w14", "other")
    docs = [(1, near), (2, "w3 " + "x " * 300 + "w12"), (3, item)]
    got = {r["doc_id"]: r for r in check(spark, docs, [(5, item)])}
    assert [got[i]["n_near"] for i in (1, 2, 3)] == [1, 0, 1]


def test_large_benchmarks_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(contamination, "BROADCAST_CHARACTERS", 0)
    rng = random.Random(4)
    items = [(i, plain.sentence(rng, 20, 60)) for i in range(6)]
    check(spark, planted(rng, items), items)


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    found = contamination.find_contamination(docs, docs.withColumnRenamed("doc_id", "item_id"))
    plan = found._jdf.queryExecution().toString()
    assert not any(name in plan for name in ("Python", "Pandas", "Arrow"))
