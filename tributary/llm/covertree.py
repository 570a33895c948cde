"""Vectors whose cosine reaches a threshold, by a dual traversal of cover trees.

On unit vectors a cosine is a distance, so the vectors are held in cover trees: nested levels of centres whose radii halve, each centre
within the radius of its parent. Two trees are walked together. A pair of nodes whose centres are further apart than the threshold and
both covering radii is dropped; one whose points all lie within the threshold is linked whole; else the children are compared.

The trees of a large table have their upper levels in common: centres from a bounded sample, kept apart by half the threshold, of each
label. Every vector belongs to its nearest centre, to its core, where all points are near each other, or to the rest. The covering radii
tell which vectors of one node may be near some of another; only those meet, in blocks, whose own trees are then walked in tasks.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import id_of, mapped, node_key, stored
from tributary.llm.graph import components

BLOCK = 2048  # vectors of a side in a block
CENTRES = 512  # expected number of sampled vectors, of all labels
SHARE = 1024  # vectors for each sampled one, at least
SAMPLE_VALUES = 1_000_000  # components of all sampled vectors
SLACK = 1e-6  # distances are rounded; cosines decide


@dataclass(frozen=True)
class Nearness:
    """Vectors are linked from this cosine on."""

    cosine: float = 0.93

    @property
    def distance(self) -> float:
        return math.sqrt(max(0.0, 2 - 2 * self.cosine))


def unit(values: np.ndarray) -> np.ndarray | None:
    """The vector with length 1, or None of one that has no direction."""
    if not len(values) or not np.isfinite(values).all():
        return None
    values = values.astype(np.float64)
    most = np.abs(values).max()
    if most == 0:
        return None
    if not 1e-100 < most < 1e100:
        values = values / most
    return values / math.sqrt(values @ values)


def units(column: pa.Array) -> np.ndarray:
    """The unit vectors of a column of vectors of one length, none of them null or zero."""
    return np.stack([unit(each) for each in column.flatten().to_numpy().reshape(len(column), -1)])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


@dataclass
class Node:
    """A ball of a tree: its centre and the points it covers, and the balls of half the radius within."""

    centre: int
    points: np.ndarray
    radius: float
    scale: float
    _children: list[Node] | None = field(default=None, repr=False)


class CoverTree:
    """Nested levels of centres over unit vectors; the children of a node are made when they are asked for."""

    LEAF = 8

    def __init__(self, points: np.ndarray):
        self.points = points
        everything = np.arange(len(points))
        away = distances(points, points[:1]).ravel()
        self.root = Node(0, everything, float(away.max()), 2.0)

    def children(self, node: Node) -> list[Node]:
        """Balls of half the radius around centres that are further apart than that, the node's own centre first."""
        if node._children is None:
            node._children = self._split(node)
        return node._children

    def leaf(self, node: Node) -> bool:
        return len(node.points) <= self.LEAF or node.radius <= SLACK

    def _split(self, node: Node) -> list[Node]:
        scale = node.scale
        while scale / 2 >= node.radius > 0:
            scale /= 2  # a level on which the node is its own only child
        scale /= 2
        left, centre, out = node.points, node.centre, []
        while len(left):
            away = np.sqrt(np.maximum(2 - 2 * (self.points[left] @ self.points[centre]), 0))
            own = away <= scale
            own |= left == centre
            out.append(Node(int(centre), left[own], float(away[own].max()), scale))
            left = left[~own]
            centre = left[0] if len(left) else None
        return out


class Links:
    """What a traversal finds: the number of links of each point, and links enough to join what is linked.

    The points of a second tree are numbered after those of the first.
    """

    def __init__(self, copies: list[np.ndarray]):
        self.copies = copies
        self.counts = [np.zeros(len(each), np.int64) for each in copies]
        self.start = 0 if len(copies) == 1 else len(copies[0])
        self.component = np.arange(sum(map(len, copies)))
        self.joined: list[tuple[int, int]] = []

    def join(self, i: int, others: np.ndarray) -> None:
        """One point with others, as far as they are apart until then."""
        found, at = np.unique(self.component[others], return_index=True)
        own = self.component[i]
        for component, j in zip(found.tolist(), others[at].tolist(), strict=True):
            if component != own:
                self.component[self.component == component] = own
                self.joined.append((i, j))

    def between(self, rows: np.ndarray, columns: np.ndarray, linked: np.ndarray) -> None:
        """Links of points of the first tree with points of the second."""
        last = len(self.copies) - 1
        self.counts[0][rows] += linked @ self.copies[last][columns]
        self.counts[last][columns] += self.copies[0][rows] @ linked
        for i in np.flatnonzero(linked.any(axis=1)).tolist():
            self.join(int(rows[i]), self.start + columns[linked[i]])

    def whole(self, rows: np.ndarray, columns: np.ndarray) -> None:
        """All points of a node with all of another."""
        last = len(self.copies) - 1
        self.counts[0][rows] += self.copies[last][columns].sum()
        self.counts[last][columns] += self.copies[0][rows].sum()
        self.join(int(rows[0]), self.start + columns)
        self.join(self.start + int(columns[0]), rows)

    def within(self, points: np.ndarray) -> None:
        """All points of a node with each other."""
        self.counts[0][points] += self.copies[0][points].sum() - self.copies[0][points]
        self.join(int(points[0]), points)


def traverse(trees: list[CoverTree], links: Links, rule: Nearness) -> None:
    """The links between two trees, or of one with itself."""
    left, right = trees[0], trees[-1]
    alone, near = len(trees) == 1, rule.distance
    pairs = [(left.root, right.root)]
    while pairs:
        a, b = pairs.pop()
        if alone and a is b:
            if 2 * a.radius <= near - SLACK:
                links.within(a.points)
                continue
            if left.leaf(a):
                linked = left.points[a.points] @ left.points[a.points].T >= rule.cosine
                links.between(a.points, a.points, np.triu(linked, 1))
                continue
            upper, lower = left.children(a), left.children(a)
        else:
            upper = [a] if left.leaf(a) else left.children(a)
            lower = [b] if right.leaf(b) else right.children(b)
            if len(upper) == len(lower) == 1 and upper[0] is a and lower[0] is b:
                links.between(a.points, b.points, left.points[a.points] @ right.points[b.points].T >= rule.cosine)
                continue
        _compare(left, right, upper, lower, alone and a is b, links, rule, pairs)


def _compare(
    left: CoverTree, right: CoverTree, upper: list[Node], lower: list[Node], same: bool, links: Links, rule: Nearness, pairs: list
) -> None:
    """Nodes against nodes by the distances of their centres; what is still open goes on ``pairs``."""
    radius = [np.array([node.radius for node in nodes]) for nodes in (upper, lower)]
    single = [np.array([len(node.points) == 1 for node in nodes]) for nodes in (upper, lower)]
    centres = [np.array([node.centre for node in nodes]) for nodes in (upper, lower)]
    for start in range(0, len(upper), 512):
        rows = slice(start, start + 512)
        cosine = left.points[centres[0][rows]] @ right.points[centres[1]].T
        apart = np.sqrt(np.maximum(2 - 2 * cosine, 0))
        reach = radius[0][rows, None] + radius[1][None]
        open_ = apart <= rule.distance + reach + SLACK
        if same:
            open_ &= np.arange(start, start + len(cosine))[:, None] <= np.arange(len(lower))[None]
        # Single points are settled by their cosine.
        both = single[0][rows, None] & single[1][None]
        settled = open_ & both & (cosine >= rule.cosine)
        if same:
            settled &= np.arange(start, start + len(cosine))[:, None] != np.arange(len(lower))[None]
        if settled.any():
            some, others = np.flatnonzero(settled.any(axis=1)), np.flatnonzero(settled.any(axis=0))
            links.between(centres[0][rows][some], centres[1][others], settled[np.ix_(some, others)])
        whole = ~both & open_ & (apart + reach <= rule.distance - SLACK)
        if same:
            whole &= np.arange(start, start + len(cosine))[:, None] != np.arange(len(lower))[None]
        for i, j in np.argwhere(whole).tolist():
            links.whole(upper[start + i].points, lower[j].points)
        for i, j in np.argwhere(open_ & ~both & ~whole).tolist():
            pairs.append((upper[start + i], lower[j]))


ROWS = "id long, label string, dim int, key binary, vector binary"


def vector_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, label, embedding -> id, label, length, key of label and direction (null if it has none), unit vector."""
    for batch in batches:
        dims, keys, vectors = [], [], []
        lists = batch.column(2)
        for label, scalar in zip(batch.column(1).to_pylist(), lists, strict=True):
            own = None
            if label is not None and scalar.is_valid and scalar.values.null_count == 0:
                own = unit(scalar.values.to_numpy(zero_copy_only=False))
            dims.append(None if own is None else len(own))
            vectors.append(None if own is None else (own + 0.0).tobytes())
            keys.append(None if own is None else xxhash.xxh3_128_digest(f"{len(label)}:{label}:".encode() + vectors[-1]))
        columns = [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "dim", "key", "vector"])


@dataclass
class Upper:
    """The centres of a label's upper levels, and what is known of their cores and rests (nodes 2 * i and 2 * i + 1)."""

    number: int  # of the first node
    centres: np.ndarray
    keys: list[bytes]
    low: np.ndarray = field(default_factory=lambda: np.empty(0))
    high: np.ndarray = field(default_factory=lambda: np.empty(0))


def upper_levels(sample: list[tuple[str, int, np.ndarray, bytes]], rule: Nearness) -> dict[tuple[str, int], Upper]:
    """Centres that are further apart than half the threshold, by label and length of vectors."""
    by, keys = defaultdict(list), defaultdict(list)
    for label, dim, vector, key in sample:
        by[label, dim].append(vector)
        keys[label, dim].append(key)
    out, number = {}, 0
    for name in sorted(by):
        points = np.stack(by[name])
        left, chosen = np.arange(len(points)), []
        while len(left):
            chosen.append(left[0])
            left = left[distances(points[left], points[left[:1]]).ravel() > rule.distance / 2]
        out[name] = Upper(number, points[chosen], [keys[name][i] for i in chosen])
        number += 2 * len(chosen)
    return out


def _groups(batch: pa.RecordBatch, upper: dict[tuple[str, int], Upper]) -> Iterator[tuple[Upper, np.ndarray, np.ndarray]]:
    """The rows (label, dim, vector in columns 0 to 2) of each label that has centres, as positions and unit vectors."""
    places = defaultdict(list)
    for i, name in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
        if name in upper:
            places[name].append(i)
    for name, at in places.items():
        flat = b"".join(batch.column(2)[i].as_py() for i in at)
        yield upper[name], np.array(at), np.frombuffer(flat).reshape(len(at), -1)


def _nodes(level: Upper, points: np.ndarray, rule: Nearness) -> tuple[np.ndarray, np.ndarray]:
    """The distances to all centres, and the node of each point: the core or the rest of the nearest centre."""
    away = distances(points, level.centres)
    nearest = away.argmin(axis=1)
    rest = away[np.arange(len(points)), nearest] > rule.distance / 2 - SLACK
    return away, 2 * nearest + rest


def node_batches(batches: Iterator[pa.RecordBatch], upper: dict, rule: Nearness) -> Iterator[pa.RecordBatch]:
    """label, dim, vector, copies -> node, vectors, copies, least and largest distance from its centre, summed up by batch."""
    for batch in batches:
        copies, out = batch.column(3).to_numpy(), []
        for level, at, points in _groups(batch, upper):
            away, node = _nodes(level, points, rule)
            own = away[np.arange(len(points)), node // 2]
            for each in np.unique(node).tolist():
                mine = node == each
                out.append((level.number + each, int(mine.sum()), int(copies[at[mine]].sum()), float(own[mine].min()), float(own[mine].max())))
        if out:
            columns = [pa.array(column) for column in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "vectors", "copies", "low", "high"])


def _reach(level: Upper, away: np.ndarray, node: np.ndarray, rule: Nearness) -> np.ndarray:
    """For each point and node, whether the node's radii let it hold a point near this one; its own node does not count."""
    to = np.repeat(away, 2, axis=1)
    near = (to <= level.high + rule.distance + SLACK) & (to >= level.low - rule.distance - SLACK)
    near[np.arange(len(node)), node] = False
    return near


def reach_batches(batches: Iterator[pa.RecordBatch], upper: dict, rule: Nearness) -> Iterator[pa.RecordBatch]:
    """label, dim, vector -> node, other, n: how many vectors of a node may be near some of another, summed up by batch."""
    for batch in batches:
        out = []
        for level, _, points in _groups(batch, upper):
            away, node = _nodes(level, points, rule)
            near = _reach(level, away, node, rule)
            for each in np.unique(node).tolist():
                n = near[node == each].sum(axis=0)
                out += [(level.number + each, level.number + other, int(n[other])) for other in np.flatnonzero(n).tolist()]
        if out:
            columns = [pa.array(column) for column in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "other", "n"])


def _parts(n: int) -> int:
    return -(-n // BLOCK)


def _block(*parts: int) -> int:
    return xxhash.xxh3_64_intdigest(np.array(parts, np.int64).tobytes()) - 2**63


BLOCKS = "block long, side int, key binary, copies long, vector binary"


def deal_batches(batches: Iterator[pa.RecordBatch], upper: dict, open_: np.ndarray, sizes: dict, rule: Nearness) -> Iterator[pa.RecordBatch]:
    """label, dim, vector, copies, key -> BLOCKS: each vector once for each block in which it may be near another.

    Points of a rest meet each other; those of two nodes meet where both have some within the other's reach (``open_`` has how many, or 0).
    A core's points are all near each other and need not meet.
    """
    for batch in batches:
        rows, blocks, sides = [], [], []
        keys = batch.column(4).to_pylist()
        for level, at, points in _groups(batch, upper):
            away, node = _nodes(level, points, rule)
            near = _reach(level, away, node, rule)
            for place, own, reach in zip(at.tolist(), (level.number + node).tolist(), near, strict=True):
                where = xxhash.xxh3_64_intdigest(keys[place], seed=1)
                for other in (level.number + np.flatnonzero(reach)).tolist():
                    if not open_[own, other]:
                        continue
                    part, first = where % _parts(int(open_[own, other])), own < other
                    for theirs in range(_parts(int(open_[other, own]))):
                        block = (own, other, part, theirs) if first else (other, own, theirs, part)
                        rows.append(place)
                        blocks.append(_block(*block))
                        sides.append(int(not first))
                if own % 2:
                    parts = _parts(sizes[own])
                    part = where % parts
                    for theirs in range(parts):
                        rows.append(place)
                        blocks.append(_block(own, own, min(part, theirs), max(part, theirs)))
                        sides.append(int(part > theirs))
        for start in range(0, len(rows), 4096):
            cut = slice(start, start + 4096)
            taken = batch.take(pa.array(rows[cut]))
            columns = [pa.array(blocks[cut], pa.int64()), pa.array(sides[cut], pa.int32()), taken.column(4), taken.column(3), taken.column(2)]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "side", "key", "copies", "vector"])


LINKS = "a binary, b binary, n long"


def core_batches(batches: Iterator[pa.RecordBatch], upper: dict, sizes: dict, first: dict, rule: Nearness) -> Iterator[pa.RecordBatch]:
    """label, dim, vector, copies, key -> LINKS of the points of cores: with all of its core, by way of one of them."""
    for batch in batches:
        copies, out = batch.column(3).to_numpy(), []
        for level, at, points in _groups(batch, upper):
            _, node = _nodes(level, points, rule)
            for place, own in zip(at.tolist(), (level.number + node).tolist(), strict=True):
                if own % 2 == 0 and sizes[own] > copies[place]:
                    out.append((batch.column(4)[place].as_py(), first[own], int(sizes[own] - copies[place])))
        if out:
            columns = [pa.array(column, kind) for column, kind in zip(zip(*out, strict=True), (pa.binary(), pa.binary(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "n"])


def whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their first column -> a batch for each value of it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            piece = batch.slice(start, end - start)
            if held and held[0].column(0)[0] != piece.column(0)[0]:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            held.append(piece)
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def link_batches(batches: Iterator[pa.RecordBatch], rule: Nearness) -> Iterator[pa.RecordBatch]:
    """BLOCKS in order -> LINKS: joining links (a, b, 0) and the number of links of each point (a, null, n)."""
    for batch in whole_blocks(batches):
        side, keys = batch.column(1).to_numpy(), batch.column(2)
        points = np.frombuffer(b"".join(batch.column(4).to_pylist())).reshape(len(side), -1)
        copies = batch.column(3).to_numpy()
        split = [np.flatnonzero(side == s) for s in (0, 1)]
        split = [at for at in split if len(at)]
        if len(split) == 1 and side[0] == 1:
            continue
        places = np.concatenate(split)
        links = Links([copies[at] for at in split])
        traverse([CoverTree(points[at]) for at in split], links, rule)
        counts = np.concatenate(links.counts)
        counted = np.flatnonzero(counts)
        a = [places[i] for i, _ in links.joined] + places[counted].tolist()
        n = [0] * len(links.joined) + counts[counted].tolist()
        b = pa.concat_arrays([keys.take(pa.array([places[j] for _, j in links.joined], pa.int64())), pa.nulls(len(counted), pa.binary())])
        yield pa.RecordBatch.from_arrays([keys.take(pa.array(a, pa.int64())), b, pa.array(n, pa.int64())], names=["a", "b", "n"])


def _without_centres(nodes: DataFrame, upper: dict) -> DataFrame:
    """BLOCKS of the labels that the sample has missed: all their vectors meet, in parts."""
    known = nodes.sparkSession.createDataFrame([*upper] or [("", -1)], "label string, dim int")
    rest = nodes.join(F.broadcast(known), ["label", "dim"], "left_anti")
    parts = rest.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    parts = parts.withColumnsRenamed({"label": "of", "dim": "size"})
    rows = rest.join(parts, (F.col("label") == F.col("of")) & (F.col("dim") == F.col("size")))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    block = F.xxhash64("label", "dim", F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") > F.col("other"), 1).otherwise(0)
    return rows.select(block.alias("block"), side.alias("side"), "key", "copies", "vector")


def _sampled(nodes: DataFrame, rule: Nearness) -> dict[tuple[str, int], Upper]:
    """The upper levels of a sample by keys, which are hashes: at most about ``CENTRES`` vectors and ``SAMPLE_VALUES`` numbers."""
    size = nodes.agg(F.count(F.lit(1)).alias("n"), F.max("dim").alias("dim")).first()
    if not size["n"]:
        return {}
    share = min(1 / SHARE, CENTRES / size["n"], SAMPLE_VALUES / size["dim"] / size["n"])
    chosen = F.pmod(F.xxhash64("key"), F.lit(2**32)) < F.lit(int(share * 2**32))
    sample = nodes.where(chosen).select("label", "dim", "vector", "key").orderBy("label", "dim", "key").collect()
    return upper_levels([(r["label"], r["dim"], np.frombuffer(r["vector"]), bytes(r["key"])) for r in sample], rule)


def find_links(nodes: DataFrame, rule: Nearness = Nearness()) -> DataFrame:
    """LINKS of distinct vectors (label, dim, vector, copies, key): counts without a vector's own copies, and links that join."""
    upper = _sampled(nodes, rule)
    vectors = nodes.select("label", "dim", "vector", "copies", "key")
    blocks = _without_centres(vectors, upper)
    if not upper:
        return _walked(blocks, rule)
    made = mapped(vectors, node_batches, "node long, vectors long, copies long, low double, high double", upper, rule)
    sums = (F.sum("vectors").alias("vectors"), F.sum("copies").alias("copies"), F.min("low").alias("low"), F.max("high").alias("high"))
    known = {r["node"]: r for r in made.groupBy("node").agg(*sums).collect()}
    for level in upper.values():
        numbers = range(level.number, level.number + 2 * len(level.centres))
        # No distance is within the bounds of an empty node.
        level.low = np.array([known[i]["low"] if i in known else np.inf for i in numbers])
        level.high = np.array([known[i]["high"] if i in known else -np.inf for i in numbers])
    reach = mapped(vectors, reach_batches, "node long, other long, n long", upper, rule).groupBy("node", "other").agg(F.sum("n").alias("n"))
    counted = reach.toArrow()
    total = max(level.number + 2 * len(level.centres) for level in upper.values())
    open_ = np.zeros((total, total), np.int64)
    open_[counted["node"].to_numpy(), counted["other"].to_numpy()] = counted["n"].to_numpy()
    open_[open_.T == 0] = 0
    sizes = {node: row["vectors"] for node, row in known.items()}
    copies = {node: row["copies"] for node, row in known.items()}
    first = {level.number + 2 * i: key for level in upper.values() for i, key in enumerate(level.keys)}
    blocks = blocks.union(mapped(vectors, deal_batches, BLOCKS, upper, open_, sizes, rule))
    return _walked(blocks, rule).union(mapped(vectors, core_batches, LINKS, upper, copies, first, rule))


def _walked(blocks: DataFrame, rule: Nearness) -> DataFrame:
    return mapped(blocks.repartition("block").sortWithinPartitions("block", "side"), link_batches, LINKS, rule)


def near_vectors(
    rows: DataFrame, id_column: str = "vec_id", label_column: str = "label", vector_column: str = "embedding", rule: Nearness = Nearness()
) -> DataFrame:
    """One row per row of ``rows``: vec_id, n_links, component_id, kept.

    Vectors of one label and length are compared. A null label, a null, empty or zero vector and one with null or
    non-finite components has no links and is its own component. Equal vectors are linked, whatever their ids. A null id is larger than
    any other, and a component of null ids has a null id and is kept. Other columns are not read.
    """
    columns = F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("string").alias("label"), F.col(vector_column).alias("embedding")
    each = stored(mapped(rows.select(*columns), vector_batches, ROWS), "vectors")
    each = each.withColumnRenamed("key", "digest")
    nodes = each.where("digest is not null").groupBy("digest")
    own = (F.first(name).alias(name) for name in ("label", "dim", "vector"))
    nodes = nodes.agg(*own, F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    nodes = nodes.withColumn("key", node_key(F.col("least"), F.col("digest"))).drop("digest", "least")
    nodes = stored(nodes, "nodes")
    links = stored(find_links(nodes, rule), "links")
    labels = components(links.where("b is not null").select("a", "b")).withColumnRenamed("node", "key")
    counts = links.groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("n"))
    known = nodes.select("key", "copies").join(counts, "key", "left").join(labels, "key", "left")
    known = known.select(
        F.substring("key", 10, 16).alias("digest"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        id_of(F.coalesce("component", "key")).alias("least"),
    )
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("least"))
    out = each.select("id", "digest").join(stored(known, "known"), "digest", "left")
    return out.select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
