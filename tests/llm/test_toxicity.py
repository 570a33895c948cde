import random
import zlib
from collections import Counter

import numpy as np
import plain
import pytest

from tributary.llm import toxicity
from tributary.llm.common import table
from tributary.llm.toxicity import Model, Training

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.fit(docs, labels, Training(epochs=4))
    return model, toxicity.score_documents(docs, model).cache()


def test_labels_that_were_held_out(spark, scored):
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    rows = [r for r in scored[1].collect() if r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"]]
    hits = sum(p and y for p, y in held)
    assert hits / sum(p for p, _ in held) > 0.85 and hits / sum(y for _, y in held) > 0.8
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_other_columns_say_nothing(spark, scored):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    changed = docs.selectExpr("doc_id + 7 as doc_id", "text", "'xx' as lang", "'other' as source", "'s' as score")
    score = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, scored[0]).collect()}
    again = {r["doc_id"] - 7: r["score"] for r in toxicity.score_documents(changed.repartition(7), scored[0]).collect()}
    assert score == pytest.approx(again, rel=1e-5)


def test_rows_that_are_odd(spark, scored):
    rows = [(1, None), (1, None), (2, ""), (None, "moron"), (3, "a " * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.score_documents(docs, scored[0]).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score_documents(docs.limit(0), scored[0]).count() == 0


@pytest.mark.parametrize("labels, score", [([], 0.0), ([(2, 0), (3, 0), (4, None)], 0.0), ([(2, 1), (3, 1)], 1.0)])
def test_labels_of_one_kind_or_none(spark, labels, score):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(1, 9)], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.score_documents(docs, model).collect()} == {score}


def test_the_sample_is_bounded_and_one_text_stands_for_an_id(spark):
    docs = spark.createDataFrame([(i, f"word{i % 2} x") for i in range(200)] + [(6, "b"), (6, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(6, 1), (None, 1)], "doc_id long, toxic int")
    seen = []
    original = toxicity.train
    toxicity.train = lambda texts, y, *rest: seen.append((texts, y)) or original(texts, y, *rest)
    try:
        toxicity.fit(docs, labels, Training(rows=40, epochs=1))
    finally:
        toxicity.train = original
    assert sorted(seen[0][1]) == [0] * 20 + [1] * 20


def by_windows(model: Model, text: str) -> float:
    """The classifier's answer, window by window."""
    t = model.training
    x = [sum(model.embedding[b] for b in toxicity.bucket_pair(w, t.buckets)) for w in toxicity.words_of(text)]
    x += [np.zeros(t.size, np.float32)] * max(t.widths)
    best = []
    for width, w, b in zip(t.widths, model.filters, model.bias, strict=True):
        windows = [sum(x[i + j] @ w[j] for j in range(width)) + b for i in range(len(x) - max(t.widths))]
        best.append(np.maximum(np.max(windows, axis=0), 0) if windows else np.zeros(t.filters))
    return float(np.concatenate(best) @ model.weights + model.offset)


def test_a_text_is_scored_alike_alone_and_among_others(scored):
    rng = random.Random(1)
    texts = [plain.sentence(rng, rng.randrange(40)) for _ in range(30)] + ["", "the moron", "!!!"]
    together = toxicity.logits(scored[0], texts)[0]
    assert together == pytest.approx([by_windows(scored[0], t) for t in texts], abs=1e-3)


def test_thresholds_by_language():
    answers = np.array([3.0, 2, 1, 0] * 10 + [9.0, 8, 7, 6] * 10)
    y = np.array([1.0, 1, 0, 0] * 20)
    languages = np.array([0] * 40 + [1] * 40)
    found = toxicity.thresholds(answers, y, np.ones(80), languages, 4)
    assert 1 <= found[0] <= 2 and 7 <= found[1] <= 8 and found[2] == found[3]


def test_languages_are_learnt_from_texts(spark, scored):
    """Of the texts of a learnt language, nearly all have one declared language, and every declared one has a learnt one."""
    languages = scored[0].languages
    rows = table(spark, SF, "documents").where("text is not null and n_chars > 200").collect()
    found = Counter((languages.of(toxicity.words_of(r["text"])), r["lang"]) for r in rows)
    declared = {of: max((n, lang) for (other, lang), n in found.items() if other == of) for of, _ in found}
    assert sum(n for n, _ in declared.values()) > 0.97 * len(rows)
    assert {lang for _, lang in declared.values()} == {r["lang"] for r in rows}


def learnt(texts: list[str]) -> toxicity.Languages:
    words = sorted({word for text in texts for word in text.encode().split()})
    return toxicity.learn_languages([np.array([words.index(w) for w in text.encode().split()], np.int64) for text in texts], words, Training())


def test_languages_of_few_or_odd_texts():
    two = [["le la et dans pour qui sur pas x%d" % i, "the of and to in that is was y%d" % i][i % 2] for i in range(20)]
    languages = learnt(two)
    assert len(languages.centres) == 2 and {languages.of(t.encode().split()) for t in two} == {0, 1}
    assert languages.of(two[0].encode().split()) != languages.of(two[1].encode().split())
    assert languages.of([]) == languages.of([b"unheard"]) == 2
    for texts in ([], [""], ["a"], ["a"] * 3):
        assert learnt(texts).of([b"a"]) == 0


def test_the_sample_is_bounded_in_characters(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "word " * 20) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int")
    given = []
    monkeypatch.setattr(toxicity, "train", lambda texts, *rest: given.append(texts))
    toxicity.fit(docs, labels, toxicity.Training(total=2_550))
    toxicity.fit(docs, labels)
    assert len(given[0]) == 25 and len(given[1]) > 200 and given[1][:25] == given[0]


def test_every_labelled_text_is_learnt_from(spark):
    """Words that only texts outside the sample have, long ones too, count for the model, however the rows are dealt."""
    rng = random.Random(3)
    plain_words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(plain_words, k=12)) + (f" vile{i % 3}" if i % 2 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    given = []
    original = toxicity.train
    training = Training(rows=8, characters=200, shard=120, rounds=8)
    long = [(i, text + " w1" * 100 if i % 5 == 0 else text) for i, text in rows]
    toxicity.train = lambda texts, *rest: given.append(texts) or original(texts, *rest)
    try:
        models = [toxicity.fit(spark.createDataFrame(long, "doc_id long, text string").repartition(n), labels, training) for n in (1, 5)]
    finally:
        toxicity.train = original
    assert len(given[0]) <= 8 and given[0] == given[1]
    assert (models[0].embedding == models[1].embedding).all() and models[0].thresholds == models[1].thresholds
    scored = toxicity.score_documents(spark.createDataFrame(long, "doc_id long, text string"), models[0]).where("held_out").collect()
    assert sum(r["predicted"] == r["doc_id"] % 2 for r in scored) > 0.9 * len(scored) > 50


def test_frequent_words_are_counted_over_all_texts(spark):
    rows = spark.createDataFrame([(f"of the rare{i} " + "the " * (i % 3),) for i in range(50)] + [("of of a b",), ("b",)], "text string")
    assert toxicity.frequent_words(rows.repartition(7), Training()) == [b"of", b"the", b"b"]
    assert toxicity.frequent_words(rows, Training(frequent=1)) == [b"of"]


def test_thresholds_of_equal_answers():
    """Answers that are alike stay on one side, and each counts as often as its weight says."""
    found = toxicity.thresholds(np.array([2.0, 1, 1, 0]), np.array([1, 1, 0, 0]), np.array([5.0, 20, 4, 50]), np.zeros(4, int), 2)
    assert found == (0.5, 0.5)


def test_an_id_counts_once_however_many_rows_it_has(spark):
    docs = spark.createDataFrame([(i, f"some words here{i % 4} " + ("moron" if i % 2 else "")) for i in range(120)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")
    training = Training(epochs=1, shard=50)
    once, often = (toxicity.fit(df, labels, training) for df in (docs, docs.union(docs).union(docs).repartition(5)))
    assert (once.embedding == often.embedding).all() and once.thresholds == often.thresholds and once.offset == often.offset
