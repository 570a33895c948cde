import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import negatives
from tributary.llm.negatives import Band, Bucket

SCHEMA = "vec_id long, embedding array<float>, label int"


def taking_part(rows):
    out = []
    for vec_id, vector, label in rows:
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            out.append((vec_id, [math.floor(256.0 * float(np.float32(x))) for x in vector], label))
    return out


def expected(rows, every=10, band=Band()):
    rows, out = taking_part(rows), collections.Counter()
    key = lambda r: (-r[0], r[1] is None, r[1] or 0)
    for a, (vec_id, vector, label) in enumerate(rows):
        if vec_id is None or vec_id % every:
            continue
        scored = [(sum(x * y for x, y in zip(vector, v, strict=True)), i, l) for b, (i, v, l) in enumerate(rows) if b != a and len(v) == len(vector)]
        positives = sorted((s for s in scored if s[2] == label), key=key)[: band.positives]
        for score, positive_id, _ in positives:
            inside = [s for s in scored if s[2] != label and band.low * score <= 100 * s[0] <= band.high * score]
            for rank, (found, negative_id, _) in enumerate(sorted(inside, key=key)[: band.negatives], 1):
                out[vec_id, positive_id, rank, negative_id, score, found] += 1
    return out


def found(spark, rows, every=10, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = negatives.hard_negatives(df, F.col("vec_id") % every == 0, **options)
    assert got.columns == names
    return collections.Counter(tuple(r[n] for n in names) for r in got.collect())


def clouds(rng, n, dim, labels=4, lengths=1.5):
    centres = rng.normal(size=(6, dim))
    vectors = [(centres[rng.integers(6)] + rng.normal(size=dim) * 0.5) * math.exp(rng.normal() * lengths) for _ in range(n)]
    return [(i, v.astype(np.float32).tolist(), int(rng.integers(labels))) for i, v in enumerate(vectors)]


@pytest.mark.parametrize(("dim", "lengths"), [(16, 0.0), (5, 1.5), (2, 1.0)])
def test_agrees_with_scoring_every_row(spark, dim, lengths):
    rows = clouds(np.random.default_rng(dim), 300, dim, lengths=lengths)
    want = expected(rows)
    assert len(want) > 300
    assert found(spark, rows) == want


@pytest.mark.parametrize("bucket", [1, 7, 50])
def test_small_buckets_chunks_and_shares_change_nothing(spark, monkeypatch, bucket):
    monkeypatch.setattr(negatives, "BUCKET", bucket)
    monkeypatch.setattr(negatives, "CHUNK_VALUES", 30)
    monkeypatch.setattr(negatives, "BROADCAST_ROWS", 0)
    rows = clouds(np.random.default_rng(bucket), 150, 4)
    assert found(spark, rows) == expected(rows)


def test_other_bands(spark):
    rows = clouds(np.random.default_rng(8), 120, 6)
    band = Band(positives=2, negatives=3, low=-50, high=120)
    assert found(spark, rows, every=3, band=band) == expected(rows, 3, band)


def test_ties_go_to_smaller_ids(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([1.0, 0.5]), rng.choice([0.0, 0.25]), 1.0], rng.randrange(2)) for i in range(200)]
    rows += [(i, [0.7, 0.2, 0.9], 1) for i in range(200, 260)]
    assert found(spark, rows) == expected(rows)


def test_candidates_hold_all_that_score_enough():
    rng = np.random.default_rng(3)
    pruned = 0
    for _ in range(300):
        dim = int(rng.integers(1, 12))
        vectors = rng.normal(size=(80, dim))
        vectors = np.floor(vectors / np.linalg.norm(vectors, axis=1)[:, None] * rng.uniform(270, 300, size=(80, 1)))  # as in a bucket
        bucket, anchor = Bucket(vectors), np.floor(rng.normal(size=dim) * 100)
        size = negatives.length(anchor)
        scores = vectors @ anchor
        least = float(np.quantile(scores, rng.choice([0.5, 0.9, 0.99])))
        rows = bucket.candidates(anchor / size if size else anchor, size, least)
        if rows is not None:
            pruned += len(rows) < 40
            assert set(np.flatnonzero(scores >= least).tolist()) <= set(rows.tolist())
    assert pruned > 50


def test_scores_beyond_doubles_are_exact():
    vectors = np.array([[2.0**60, 1.0], [2.0**60, 2.0], [3.0, -(2.0**70)]])
    got = Bucket(vectors).scores(np.arange(3), np.array([2.0**20, 1.0]))
    assert got.tolist() == [2**80 + 1, 2**80 + 2, 3 * 2**20 - 2**70]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 0.5]
    rows = [(i, [1.0 + i / 50, 0.5], i % 3) for i in range(40)]
    rows += [(50, one, None), (60, None, 1), (70, [1.0, None], 1), (80, [nan, 1.0], 1), (90, [1.0, inf], 2), (100, [], 1), (110, [], 1), (120, [], 2)]
    rows += [(None, one, 1), (None, one, 2), (None, None, None), (10, [1.2, 0.5], 1), (10, [1.2, 0.5], 1), (130, [0.0, 0.0], 1), (140, [1.0], 1), (141, [1.0], 1), (142, [0.8], 2)]
    rows += [(150, [-1.0, -0.5], 0), (160, [3e38, 1.0], 5), (161, [3e38, 1.0], 5)]
    want = expected(rows)
    limit = 2**63 - 1
    clipped = collections.Counter({tuple(limit if x is not None and x > limit else x for x in k): n for k, n in want.items()})
    assert found(spark, rows) == clipped
    extra = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", row int, anchor int, wanted int")
    assert negatives.hard_negatives(extra, F.col("vec_id") % 10 == 0).count() == sum(want.values())
    assert found(spark, rows, every=10**6) == expected(rows, 10**6)
    empty = spark.createDataFrame([], SCHEMA)
    assert negatives.hard_negatives(empty, F.col("vec_id") % 10 == 0).count() == 0
