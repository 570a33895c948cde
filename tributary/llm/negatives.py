"""Hard negatives by inner product, with candidates pruned by length and by coordinates.

For each anchor the best other vectors of its label are its positives, and the best of other labels whose score lies in a band below a
positive's score are the negatives. Vectors are held in buckets of similar length. Where an anchor has found as many as it needs, the
least score that would still count, divided by both lengths, is a cosine that a vector must reach. A bucket that cannot reach it is left
out whole. In others, each of the anchor's largest coordinates bounds the same coordinate of such a vector: the bucket's sorted lists give the
rows within these ranges, their intersection is verified by exact scores.

Anchors and rows meet in groups of a chunk of anchors and a share of the rows, longest first. A group holds its anchors and one bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import mapped, stored

RATIO = 0.9  # of the shortest to the longest vector of a bucket
BUCKET = 4096  # rows of a bucket in memory
CHUNK_VALUES = 4_000_000  # components of the anchors of a group, 32 MB
FOCUS = 4  # coordinates looked at
BROADCAST_ROWS = 1_000_000
SLACK = 1e-9
EXACT = 2**53  # whole numbers up to here are exact as doubles
LEAST, MOST = -(2**63), 2**63 - 1


@dataclass(frozen=True)
class Band:
    """How many positives and negatives are wanted, and the bounds of a negative's score in hundredths of the positive's."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90

    def bounds(self, score: int) -> tuple[int, int]:
        """The least and largest score of a negative; none if the first is larger."""
        return -(-self.low * score // 100), self.high * score // 100


def length(vector: np.ndarray) -> float:
    most = np.abs(vector).max(initial=0.0)
    return float(most * math.sqrt(((vector / most) ** 2).sum())) if most else 0.0


def vector_batches(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """id, label, anchor, embedding -> VECTORS of the rows that take part."""
    for batch in batches:
        kept, buckets, dims, vectors = [], [], [], []
        for i, (label, scalar) in enumerate(zip(batch.column(1), batch.column(3), strict=True)):
            if not label.is_valid or not scalar.is_valid or scalar.values.null_count:
                continue
            with np.errstate(over="ignore", invalid="ignore"):
                vector = np.floor(scale * scalar.values.to_numpy(zero_copy_only=False).astype(np.float64))
            if not np.isfinite(vector).all():
                continue
            size = length(vector)
            kept.append(i)
            dims.append(len(vector))
            buckets.append(math.floor(math.log(size) / -math.log(RATIO)) if size else -1)
            vectors.append((vector + 0.0).tobytes())
        rows = batch.take(pa.array(kept, pa.int64()))
        columns = [*(rows.column(i) for i in range(3)), pa.array(dims, pa.int32()), pa.array(buckets, pa.int32()), pa.array(vectors, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "anchor", "dim", "bucket", "vector"])


VECTORS = "id long, label string, anchor boolean, dim int, bucket int, vector binary"


def whole(vector: np.ndarray) -> list[int]:
    return [int(x) for x in vector.tolist()]


class Bucket:
    """Vectors of similar length, with a sorted list of each coordinate of their directions."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        lengths = np.array([length(v) for v in vectors])
        self.longest = float(lengths.max())
        self.unit = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        self.largest = float(np.abs(vectors).max(initial=0.0))
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        if coordinate not in self._lists:
            order = np.argsort(self.unit[:, coordinate], kind="stable")
            self._lists[coordinate] = self.unit[order, coordinate], order
        return self._lists[coordinate]

    def candidates(self, direction: np.ndarray, size: float, least: float) -> np.ndarray | None:
        """The rows that may score ``least`` or more with an anchor of this direction and length; None for all.

        The angle between two vectors is no less than the difference of their angles to an axis.
        """
        if least <= 0:
            return None
        reach = size * self.longest
        if least > reach * (1 + SLACK):
            return np.empty(0, np.int64)
        angle = math.acos(min(1.0, least / reach))
        spans = []
        for coordinate in np.argsort(-np.abs(direction), kind="stable")[:FOCUS].tolist():
            own = math.acos(max(-1.0, min(1.0, direction[coordinate])))
            low, high = math.cos(min(math.pi, own + angle)) - SLACK, math.cos(max(0.0, own - angle)) + SLACK
            values, _ = self.sorted(coordinate)
            start, end = np.searchsorted(values, low), np.searchsorted(values, high, side="right")
            spans.append((int(end - start), coordinate, int(start), int(end), low, high))
        spans.sort()
        n, coordinate, start, end, *_ = spans[0]
        if 2 * n > len(self.vectors):
            return None
        rows = self.sorted(coordinate)[1][start:end]
        for _, coordinate, _, _, low, high in spans[1:]:
            values = self.unit[rows, coordinate]
            rows = rows[(values >= low) & (values <= high)]
        return rows

    def scores(self, rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
        """Exact inner products, as whole numbers of any size."""
        largest = float(np.abs(vector).max(initial=0.0))
        if self.largest * largest * len(vector) < EXACT:
            return (self.vectors[rows] @ vector).astype(np.int64)
        own = whole(vector)
        return np.array([sum(a * b for a, b in zip(own, whole(v), strict=True)) for v in self.vectors[rows]], object)


Found = tuple[int, bool, int, int]  # less the score, whether the id is null, the id, the row


class Top:
    """The best rows so far: higher scores first, then smaller ids."""

    def __init__(self, n: int):
        self.n, self.rows = n, []

    @property
    def least(self) -> int | None:
        """The least score that may still come in; None while there is room."""
        return -self.rows[-1][0] if len(self.rows) == self.n else None

    def add(self, scores: np.ndarray, ids: list, rows: np.ndarray) -> None:
        least = self.least
        if least is not None:
            better = scores >= least
            scores, rows = scores[better], rows[better]
        if len(scores) > 4 * self.n:
            # All with the last score that counts stay, as ids tell between them.
            last = np.partition(scores, len(scores) - self.n)[len(scores) - self.n] if scores.dtype != object else sorted(scores)[-self.n]
            better = scores >= last
            scores, rows = scores[better], rows[better]
        if len(scores):
            new = [(-score, ids[i][0] is None, ids[i][0] or 0, ids[i][1]) for score, i in zip(scores.tolist(), rows.tolist(), strict=True)]
            self.rows = sorted(self.rows + new)[: self.n]


class Anchor:
    """An anchor of a group; ``wanted`` has the scores of its positives when negatives are looked for."""

    def __init__(self, row: int, label: int, vector: np.ndarray, wanted: list[int] | None, band: Band):
        self.row, self.label, self.vector = row, label, vector
        self.length = length(vector)
        self.direction = vector / self.length if self.length else vector
        self.top = Top(band.positives)
        self.bands: dict[int, tuple[int, int, Top]] = {}
        self.mines = wanted is not None
        for score in wanted or []:
            low, high = band.bounds(score)
            if low <= high:
                self.bands[score] = low, high, Top(band.negatives)

    def positives(self, bucket: Bucket, labels: np.ndarray, ids: list) -> None:
        least = self.top.least
        rows = bucket.candidates(self.direction, self.length, -math.inf if least is None else least)
        rows = np.flatnonzero(labels == self.label) if rows is None else rows[labels[rows] == self.label]
        rows = rows[np.array([ids[i][1] != self.row for i in rows.tolist()], bool)]
        if len(rows):
            self.top.add(bucket.scores(rows, self.vector), ids, rows)

    def negatives(self, bucket: Bucket, labels: np.ndarray, ids: list) -> None:
        if not self.bands:
            return
        least = min(max(low, low if top.least is None else top.least) for low, _, top in self.bands.values())
        rows = bucket.candidates(self.direction, self.length, least)
        rows = np.flatnonzero(labels != self.label) if rows is None else rows[labels[rows] != self.label]
        if not len(rows):
            return
        scores = bucket.scores(rows, self.vector)
        for low, high, top in self.bands.values():
            inside = (scores >= low) & (scores <= high)
            top.add(scores[inside], ids, rows[inside])

    def found(self) -> Iterator[tuple[int, int, Found]]:
        """The anchor's row, the score looked below (0 for positives), and what was found."""
        for each in self.top.rows:
            yield self.row, 0, each
        for score, (_, _, top) in self.bands.items():
            for each in top.rows:
                yield self.row, score, each


MET = "anchor long, below long, score long, id long, row long"


def _found_batch(anchors: list[Anchor]) -> pa.RecordBatch:
    out = [(a, below, -less, None if unknown else i, row) for anchor in anchors for a, below, (less, unknown, i, row) in anchor.found()]
    columns = [[max(LEAST, min(MOST, x)) if x is not None else None for x in column] for column in zip(*out, strict=True)] or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor", "below", "score", "id", "row"])


def meet_batches(batches: Iterator[pa.RecordBatch], band: Band) -> Iterator[pa.RecordBatch]:
    """group, side, bucket, row, id, label, vector, wanted in the order of groups, anchors (side 0) first, then rows, longest first -> MET.

    Positives are looked for where ``wanted`` is null, else negatives below each of its scores.
    """
    group, anchors, codes = None, [], {}
    held: list[tuple] = []  # rows of one bucket
    bucket_of = None

    def searched() -> None:
        if not held:
            return
        bucket = Bucket(np.frombuffer(b"".join(r[3] for r in held)).reshape(len(held), -1))
        labels, ids = np.array([r[2] for r in held]), [(r[1], r[0]) for r in held]
        for anchor in anchors:
            (anchor.negatives if anchor.mines else anchor.positives)(bucket, labels, ids)
        held.clear()

    for batch in batches:
        for each, side, bucket, row, i, label, vector, wanted in zip(*(batch.column(k).to_pylist() for k in range(8)), strict=True):
            if each != group:
                searched()
                if anchors:
                    yield _found_batch(anchors)
                group, anchors, codes, bucket_of = each, [], {}, None
            code = codes.setdefault(label, len(codes))
            if side == 0:
                anchors.append(Anchor(row, code, np.frombuffer(vector), wanted, band))
                continue
            if bucket != bucket_of or len(held) == BUCKET:
                searched()
                bucket_of = bucket
            held.append((row, i, code, vector))
    searched()
    if anchors:
        yield _found_batch(anchors)


def _groups(vectors: DataFrame, anchors: DataFrame, n_anchors: int) -> DataFrame:
    """Each chunk of anchors with each share of the rows, of vectors of one length.

    As many shares are made as cost no more copies of anchors than there are copies of rows.
    """
    sizes = vectors.groupBy(F.col("dim").alias("of")).agg(F.count(F.lit(1)).alias("n"))
    chunks = F.greatest(F.lit(1), F.ceil(F.lit(n_anchors) * F.col("of") / CHUNK_VALUES)).cast("int")
    shares = F.least(F.ceil(F.col("n") / BUCKET), F.ceil(F.col("n") * chunks / max(1, n_anchors))).cast("int")
    sizes = sizes.select("of", chunks.alias("chunks"), shares.alias("shares"))
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes
    share, chunk = F.pmod(F.xxhash64("row"), F.col("shares")), F.pmod(F.xxhash64("row"), F.col("chunks"))
    columns = ["bucket", "row", "id", "label", "vector"]

    def dealt(df: DataFrame, side: int, chunk: Column, share: Column, wanted: Column) -> DataFrame:
        df = df.join(sizes, F.col("dim") == F.col("of")).withColumn("chunk", chunk).withColumn("share", share)
        group = F.xxhash64("dim", F.col("chunk").cast("long"), F.col("share").cast("long")).alias("group")
        return df.select(group, F.lit(side).alias("side"), *columns, wanted.alias("wanted"))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    none = F.lit(None).cast("array<long>")
    both = dealt(anchors, 0, chunk, every("shares"), F.col("wanted")).union(dealt(vectors, 1, every("chunks"), share, none))
    return both.repartition("group").sortWithinPartitions("group", "side", F.desc("bucket"))


def _best(met: DataFrame, n: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    id_column: str = "vec_id",
    label_column: str = "label",
    vector_column: str = "embedding",
    scale: float = 256.0,
    band: Band = Band(),
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for each row that ``anchors`` holds for.

    Scores are inner products of the components times ``scale``, rounded down. Only vectors of one length have a score. Rows with a null label, a null
    vector, or a component that is null or not finite, before or after scaling, take no part; an empty or zero vector scores 0. A
    null id is larger than any other. Rows of equal ids are rows of their own, and so are equal anchors. A
    score beyond a long is given as its limit. Other columns are not read.
    """
    taken = F.col(id_column).cast("long"), F.col(label_column).cast("string"), F.coalesce(anchors, F.lit(False)), F.col(vector_column)
    named = [column.alias(name) for column, name in zip(taken, ("id", "label", "anchor", "embedding"), strict=True)]
    vectors = mapped(rows.select(*named), vector_batches, VECTORS, scale)
    vectors = stored(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    chosen = vectors.where("anchor")
    n_anchors = chosen.count()

    met = mapped(_groups(vectors, chosen.withColumn("wanted", F.lit(None).cast("array<long>")), n_anchors), meet_batches, MET, band)
    positives = stored(_best(met, band.positives, "anchor").select("anchor", "score", F.col("id").alias("positive_id")), "positives")
    wanted = positives.groupBy(F.col("anchor").alias("a")).agg(F.collect_set("score").alias("wanted"))
    wanted = chosen.join(wanted, F.col("row") == F.col("a"))
    met = mapped(_groups(vectors, wanted, n_anchors), meet_batches, MET, band)
    negatives = _best(met, band.negatives, "anchor", "below")
    negatives = negatives.select("anchor", "below", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = chosen.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    found = positives.withColumnRenamed("score", "below").join(negatives, ["anchor", "below"]).join(ids, "anchor")
    return found.select("anchor_id", "positive_id", "rank", "negative_id", F.col("below").alias("positive_score"), "negative_score")
