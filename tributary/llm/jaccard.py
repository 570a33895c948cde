"""Texts whose sets of word shingles are similar, by signatures of partitions of the shingle domain.

Two sets with a Jaccard similarity of at least t differ in a bounded number of
shingles, given their sizes (PartEnum). The hashed domain is cut into parts so many that one of them holds at
most one differing shingle, and each part into three: a signature stands for two of the three, and of the three subsets of this kind one
is the same in both sets. Small sets have one part, cut into more, of which all subsets of a number that the differences must
leave alone are signed. Each set has signatures in every size band it can share with a similar set, and similar sets share one.

Sets that share a signature are compared with the smallest of their group first;
what this leaves in several components is then compared block by block. Sketches, counts of
the shingles in a coarse partition, rule most pairs out before any shingles are moved.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import ASCII_LOWER, id_of, mapped, node_key, same, small, stored, text_key, unused
from tributary.llm.graph import components

MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
SEEN = 100_000  # sets a task remembers to have signed
BAND = 1.5  # ratio of the largest to the smallest size of a band
BLOCK = 512  # sets compared in one task at a time
BLOCK_CODES = 2_000_000  # and shingles of these, 16 MB
BROADCAST_ROWS = 1_000_000  # 16 bytes each


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``words`` words; sets are similar from ``percent`` of their union on."""

    words: int = 5
    percent: int = 80

    def differences(self, total: int) -> int:
        """The most shingles that are in one of two similar sets of these sizes together, but not in both."""
        return total - 2 * -(-self.percent * total // (100 + self.percent))

    def largest(self, size: int) -> int:
        return size * 100 // self.percent

    def smallest(self, size: int) -> int:
        return -(-size * self.percent // 100)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX[0]
    x = (x ^ (x >> np.uint64(29))) * MIX[1]
    return x ^ (x >> np.uint64(32))


def shingles(text: str, n: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    words = text.encode().translate(ASCII_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter(map(digest, words), np.uint64, len(words))
    n = min(n, len(words))
    code = np.full(len(words) - n + 1, n, np.uint64)
    for step in range(n):
        code = mixed(code * MIX[2] + hashes[step : len(words) - n + 1 + step])
    return np.unique(code)


@dataclass(frozen=True)
class Scheme:
    """How the sets of a band are signed: ``parts`` parts, each cut into ``inner`` ones, and subsets that leave ``out`` of these out."""

    parts: int
    inner: int
    out: int
    differences: int


@cache
def bands(rule: Similarity, limit: int) -> tuple[tuple[int, int], ...]:
    """The size bands up to ``limit``: first and last size of the smaller set of a pair."""
    out, low = [], 1
    while low <= limit:
        high = max(low, math.floor(low * BAND))
        out.append((low, high))
        low = high + 1
    return tuple(out)


@cache
def scheme(rule: Similarity, low: int, high: int) -> Scheme:
    """The parts of a band. Without differences there is nothing to sign: such sets are equal.

    Up to 3 differences, one part is cut into twice as many and one more, and as many as can differ are left out. Beyond, there are
    more than half as many parts as differences, so that one has one at most, and a quarter more, so that a few may be empty.
    """
    most = max(map(rule.differences, range(2 * low, high + rule.largest(high) + 1)))
    if most <= 0:
        return Scheme(0, 0, 0, 0)
    if most <= 3:
        return Scheme(1, 2 * most + 1, most, most)
    needed = most // 2 + 1
    return Scheme(needed + max(2, needed // 4), 3, 1, most)


@cache
def edges(parts: int) -> np.ndarray:
    """Where the parts of the domain begin, but for the first."""
    return np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)


@cache
def salts(number: int, parts: int) -> np.ndarray:
    return mixed(np.arange(1, parts + 1, dtype=np.uint64) * MIX[0] + np.uint64(number))


def signatures(codes: np.ndarray, rule: Similarity) -> np.ndarray:
    """The signatures of a set, its codes in order, for the bands of all smaller and equal similar sets."""
    size = len(codes)
    out = []
    # A sum of mixed hashes stands for the shingles of a part.
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(codes * MIX[1]))])
    for number, (low, high) in enumerate(bands(rule, size)):
        if high < rule.smallest(size):
            continue
        plan = scheme(rule, low, high)
        if not plan.parts:
            continue
        cuts = plan.parts * plan.inner
        at = np.concatenate([[0], np.searchsorted(codes, edges(cuts)), [size]])
        counts, sums = np.diff(at).reshape(plan.parts, -1), np.diff(upto[at]).reshape(plan.parts, -1)
        if plan.parts == 1:
            each = mixed(sums[0] + salts(number, cuts))
            for subset in itertools.combinations(range(cuts), cuts - plan.out):
                out.append(mixed(each[list(subset)].sum(keepdims=True) * MIX[2] + np.uint64(1)))
            continue
        signed = mixed((sums.sum(axis=1, keepdims=True) - sums) * MIX[2] + salts(number, cuts).reshape(sums.shape))
        # Parts with shingles left whichever third is left out: if enough of them have to be alike but for
        # one difference, signatures of no shingles are not needed.
        full = (np.count_nonzero(counts, axis=1) > 1).sum()
        filled = counts.sum(axis=1, keepdims=True) > counts
        out.append(signed[filled] if 2 * full > plan.differences else signed.ravel())
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def node_of(codes: np.ndarray) -> int:
    """The short id of a set, under which it is signed; sets that share one are told apart by their digests."""
    return xxhash.xxh3_64_intdigest(codes.tobytes()) - 2**63


def digest_of(codes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(codes.tobytes())


def sketch(codes: np.ndarray) -> np.ndarray:
    """Counts, up to 3, of a set's shingles in a partition of as many parts as it has shingles, or up to twice as many."""
    parts = 1 << max(2, (len(codes) - 1).bit_length())
    counts = np.bincount((codes & np.uint64(parts - 1)).astype(np.int64), minlength=parts)
    return np.minimum(counts, 3).astype(np.int8)


def folded(counts: np.ndarray, parts: int) -> np.ndarray:
    """A sketch as it would be with fewer parts."""
    while len(counts) > parts:
        half = len(counts) // 2
        counts = np.minimum(counts[:half] + counts[half:], 3)
    return counts


def packed(counts: np.ndarray) -> bytes:
    return (counts.reshape(-1, 4) << np.array([0, 2, 4, 6])).sum(1).astype(np.uint8).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return ((np.frombuffer(data, np.uint8)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int8).ravel()


class Sketches:
    """The sketches of several sets, compared with as many parts as both of two have.

    Sets differ in at least as many shingles as their counts differ by in all.
    """

    def __init__(self, sketches: list[np.ndarray], sizes: np.ndarray, rule: Similarity):
        self.sketches, self.sizes, self.rule = sketches, sizes, rule
        self.parts = np.array([len(counts) for counts in sketches])
        self.rows: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _with(self, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Sketches folded to so many parts, and the row of each set that has as many."""
        if parts not in self.rows:
            chosen = np.flatnonzero(self.parts >= parts)
            place = np.full(len(self.parts), -1)
            place[chosen] = np.arange(len(chosen))
            self.rows[parts] = np.stack([folded(self.sketches[i], parts) for i in chosen]), place
        return self.rows[parts]

    def near(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of the others that a set may be similar to, by sizes and sketches.

        Similar sets differ in at most (100 - percent) / (100 + percent) of the sum of their sizes.
        """
        percent, size = self.rule.percent, self.sizes[others]
        others = others[100 * np.minimum(size, self.sizes[i]) >= percent * np.maximum(size, self.sizes[i])]
        out = []
        for parts in np.unique(self.parts[others]).tolist():
            alike = others[self.parts[others] == parts]
            table, place = self._with(min(parts, int(self.parts[i])))
            apart = np.abs(table[place[alike]] - table[place[i]]).sum(axis=1, dtype=np.int64)
            out.append(alike[apart * (100 + percent) <= (100 - percent) * (self.sizes[alike] + self.sizes[i])])
        return np.sort(np.concatenate(out)) if out else others


SETS = "doc_id long, text_hash long, n_shingles long, node long, digest binary, sketch binary"


def set_batches(batches: Iterator[pa.RecordBatch], rule: Similarity) -> Iterator[pa.RecordBatch]:
    """doc_id, text_hash, text -> doc_id, text_hash, n_shingles, node, digest and sketch (null without shingles)."""
    for batch in batches:
        sizes, nodes, digests, sketches = [], [], [], []
        for scalar in batch.column(2):
            codes = shingles(scalar.as_py() or "", rule.words)
            sizes.append(len(codes))
            nodes.append(node_of(codes) if len(codes) else None)
            digests.append(digest_of(codes) if len(codes) else None)
            sketches.append(packed(sketch(codes)) if len(codes) else None)
        columns = [pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary())]
        names = [part.split()[0] for part in SETS.split(", ")]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=names)


def signature_batches(batches: Iterator[pa.RecordBatch], rule: Similarity) -> Iterator[pa.RecordBatch]:
    """text -> signature, node; of the copies that a task meets, mostly once."""
    seen: set[int] = set()
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            found, nodes = [], []
            for scalar in batch.column(0).slice(start, 256):
                codes = shingles(scalar.as_py() or "", rule.words)
                node = node_of(codes)
                if len(codes) and node not in seen:
                    seen.add(node)
                    own = signatures(codes, rule)
                    found.append(own.view(np.int64))
                    nodes.append(np.full(len(own), node, np.int64))
            if len(seen) > SEEN:
                seen.clear()
            if found:
                columns = [pa.array(np.concatenate(found)), pa.array(np.concatenate(nodes))]
                yield pa.RecordBatch.from_arrays(columns, names=["signature", "node"])


def code_batches(batches: Iterator[pa.RecordBatch], rule: Similarity) -> Iterator[pa.RecordBatch]:
    """text -> digest, codes; copies that a task meets come once."""
    seen: set[bytes] = set()
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            sets = {}
            for scalar in batch.column(0).slice(start, 256):
                codes = shingles(scalar.as_py() or "", rule.words)
                sets[digest_of(codes)] = codes
            sets = {digest: codes for digest, codes in sets.items() if len(codes) and digest not in seen}
            seen.update(sets)
            if len(seen) > SEEN:
                seen.clear()
            if sets:
                ends = np.cumsum([0, *map(len, sets.values())], dtype=np.int32)
                codes = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(list(sets.values())).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(list(sets), pa.binary()), codes], names=["digest", "codes"])


def shared_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """signature, node in this order -> first, node: the smallest node of a signature with each other one.

    One row is kept between batches, however many nodes a signature has.
    """
    held: tuple | None = None  # the signature and its first node
    for batch in batches:
        signature, node = (batch.column(i).to_numpy() for i in range(2))
        if held:
            signature, node = np.append(held[0], signature), np.append(held[1], node)
        follows = np.append(False, signature[1:] == signature[:-1])
        first = node[np.maximum.accumulate(np.where(follows, 0, np.arange(len(node))))]
        held = signature[-1], first[-1]
        pairs = np.unique(np.stack([first, node], 1)[first != node], axis=0)
        if len(pairs):
            columns = [pa.array(pairs[:, k], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["first", "node"])


def similar(a: np.ndarray, b: np.ndarray, rule: Similarity) -> bool:
    if 100 * min(len(a), len(b)) < rule.percent * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= rule.percent * (len(a) + len(b) - shared)


def joining_links(
    left: np.ndarray, right: np.ndarray, sets: list[np.ndarray], root: list[int], rule: Similarity
) -> Iterator[tuple[int, int]]:
    """Links between two lists of sets, each of which joins what ``root`` has apart until then."""

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    within = left is right
    sketches = Sketches([sketch(codes) for codes in sets], np.array([len(codes) for codes in sets]), rule)
    for i in left.tolist():
        for j in sketches.near(i, right[right > i] if within else right).tolist():
            if find(i) != find(j) and similar(sets[i], sets[j], rule):
                root[find(j)] = find(i)
                yield i, j


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[tuple[int, int]]]]:
    """Batches of whole blocks, from rows in the order of their block, and where each block starts and ends."""

    def cut(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, list[tuple[int, int]]]:
        block = batch.column(0).to_numpy()
        edges = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block)).tolist()
        return batch, list(zip(edges[:-1], edges[1:], strict=True))

    held: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        block = batch.column(0).to_numpy()
        end = int(np.searchsorted(block, block[-1]))
        held = batch.slice(end)
        if end:
            yield cut(batch.slice(0, end))
    if held is not None:
        yield cut(held)


def _sides(side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    return (left, right) if len(right) else (left, left)


BLOCKS = "block long, side int, key binary, component binary"


def _components(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(3).dictionary_encode().indices.to_numpy()


def near_batches(batches: Iterator[pa.RecordBatch], rule: Similarity) -> Iterator[pa.RecordBatch]:
    """BLOCKS, size, sketch in the order of blocks -> the rows that may be similar to one of another component.

    The sets of a block's side 0 are compared with those of side 1 or, where it has none, with each other.
    """
    for batch, edges in _blocks(batches):
        side, component, size = batch.column(1).to_numpy(), _components(batch), batch.column(4).to_numpy()
        near = np.zeros(len(side), bool)
        for start, end in edges:
            own = component[start:end]
            left, right = _sides(side[start:end])
            counts = [unpacked(data.as_py()) for data in batch.column(5).slice(start, end - start)]
            sketches = Sketches(counts, size[start:end], rule)
            for i in left.tolist():
                found = sketches.near(i, right[own[right] != own[i]])
                if len(found):
                    near[start + i] = True
                    near[start + found] = True
        if near.any():
            yield batch.filter(pa.array(near)).select(["block", "side", "key", "component"])


def compare_batches(batches: Iterator[pa.RecordBatch], rule: Similarity) -> Iterator[pa.RecordBatch]:
    """BLOCKS, codes in the order of blocks -> links a, b, found as for ``near_batches``."""
    for batch, edges in _blocks(batches):
        side, keys, component = batch.column(1).to_numpy(), batch.column(2), _components(batch)
        ends = batch.column(4).offsets.to_numpy()
        flat = batch.column(4).values.to_numpy().view(np.uint64)
        links: list[tuple[int, int]] = []
        for start, end in edges:
            sets = [flat[ends[i] : ends[i + 1]] for i in range(start, end)]
            known: dict[int, int] = {}
            root = [known.setdefault(c, i) for i, c in enumerate(component[start:end].tolist())]
            found = joining_links(*_sides(side[start:end]), sets, root, rule)
            links += [(start + i, start + j) for i, j in found]
        columns = [keys.take(pa.array([link[k] for link in links], pa.int64())) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _in_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition("block").sortWithinPartitions("block", "side")


def _n_blocks() -> Column:
    """The number of blocks for a group, by its sets and by its shingles."""
    return F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("size") / BLOCK_CODES)).cast("int")


def star_blocks(pairs: DataFrame) -> DataFrame:
    """Each first node against its other ones, in blocks of about ``BLOCK``."""
    many = stored(pairs.groupBy("first").agg(_n_blocks().alias("blocks")).where("blocks > 1"), "many")
    part = F.pmod(F.xxhash64("node"), F.coalesce("blocks", F.lit(1)))
    dealt = pairs.join(small(many), "first", "left").select("first", "node", F.xxhash64("first", part).alias("block"))
    centre = dealt.select("block", F.lit(0).alias("side"), F.col("first").alias("node")).distinct()
    return dealt.select("block", F.lit(1).alias("side"), "node").union(centre)


def open_blocks(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes that have a first one in common and are in several components.

    More than ``BLOCK`` are cut into parts, and each pair of parts is a block, so
    that all are compared and no task holds more than two parts.
    """
    labelled = pairs.join(nodes.select("node", "component"), "node")
    several = labelled.groupBy("first").agg(_n_blocks().alias("parts"), F.min("component").alias("low"), F.max("component").alias("high"))
    several = stored(several.where("low != high").select("first", "parts"), "several")
    rows = pairs.join(small(several), "first")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    block = F.xxhash64("first", F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") > F.col("other"), 1).otherwise(0)
    return rows.select(block.alias("block"), side.alias("side"), "node")


def _links(blocks: DataFrame, nodes: DataFrame, rows: DataFrame, rule: Similarity) -> DataFrame:
    """The links of blocks of nodes, whose texts are read again if their sketches are near."""
    sketched = blocks.join(nodes.select("node", "key", "component", "size", "sketch"), "node")
    sketched = _in_blocks(sketched.select("block", "side", "key", "component", "size", "sketch"))
    near = stored(mapped(sketched, near_batches, BLOCKS, rule), "near")
    wanted = nodes.join(near.select("key").distinct(), "key", "left_semi").select("w_id", "w_hash")
    wanted = small(stored(wanted, "wanted"), BROADCAST_ROWS)
    matches = same(F.col("doc_id"), F.col("w_id")) & (F.col("text_hash") == F.col("w_hash"))
    codes = mapped(rows.join(wanted, matches, "left_semi").select("text"), code_batches, "digest binary, codes array<long>", rule)
    compared = near.withColumn("digest", F.substring("key", 10, 16)).join(codes, "digest")
    compared = _in_blocks(compared.select("block", "side", "key", "component", "codes"))
    return stored(mapped(compared, compare_batches, "a binary, b binary", rule), "links")


def similar_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rule: Similarity = Similarity()
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_shingles, component_id, component_size and component.

    ``component_id`` is the smallest doc_id reachable by links, its own included; ``component`` tells
    components apart whatever their ids, and is null for an empty set.
    A text of fewer words than a shingle is one shingle. Null and empty texts have an empty
    set and no links. Rows with equal sets are linked, whatever their ids. A
    null id is larger than any other. Other columns are not read.
    """
    text = F.col(text_column)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_key(text).alias("text_hash"), text.alias("text"))
    sets = stored(mapped(rows, set_batches, SETS, rule), "sets")
    signed = mapped(rows.select("text"), signature_batches, "signature long, node long", rule)
    dealt = signed.repartition("signature").sortWithinPartitions("signature", "node")
    pairs = mapped(dealt, shared_batches, "first long, node long").distinct()

    # The distinct sets, each with one of its texts.
    one = F.min_by(F.struct("node", "n_shingles", "doc_id", "text_hash", "sketch"), "text_hash")
    nodes = sets.where("digest is not null").groupBy("digest")
    nodes = nodes.agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"), one.alias("w"))
    own = F.col("w.n_shingles").alias("size"), F.col("w.doc_id").alias("w_id"), F.col("w.text_hash").alias("w_hash")
    nodes = stored(nodes.select("w.node", node_key(F.col("least"), F.col("digest")).alias("key"), "copies", *own, "w.sketch"), "nodes")

    pairs = stored(pairs.join(nodes.groupBy("node").agg(F.max("size").alias("size")), "node"), "sized")
    links = _links(star_blocks(pairs), nodes.withColumn("component", F.col("key")), rows, rule)
    labels = components(links).withColumnRenamed("node", "key")
    labelled = nodes.join(labels, "key", "left").withColumn("component", F.coalesce("component", "key"))
    links = links.union(_links(open_blocks(pairs, labelled), labelled, rows, rule))

    labels = components(links).withColumnRenamed("node", "key")  # of two stored tables
    linked = stored(nodes.select("key", "copies").join(labels, "key"), "labels")
    sizes = stored(linked.groupBy("component").agg(F.sum("copies").alias("n")), "components")
    linked = linked.join(small(sizes), "component").select("key", "component", "n")
    known = nodes.select("key", "copies").join(linked, "key", "left")
    component = F.coalesce("component", "key")
    known = known.select(F.substring("key", 10, 16).alias("digest"), component.alias("component"), F.coalesce("n", "copies").alias("n"))
    known = stored(known, "known")
    return sets.join(known, "digest", "left").select(
        "doc_id",
        "text_hash",
        "n_shingles",
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(id_of(F.col("component"))).alias("component_id"),
        F.coalesce("n", F.lit(1)).alias("component_size"),
        "component",
    )


def keep_one(docs: DataFrame, rule: Similarity = Similarity()) -> DataFrame:
    """Of each component the row with the smallest id, of several such rows one; rows without words all stay."""
    found = stored(similar_documents(docs, rule=rule).where("component is not null"), "found")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    chosen = found.groupBy("component").agg(F.min(order).alias("w")).select("w.doc_id", "w.text_hash")
    gone = found.select("doc_id", "text_hash").distinct().exceptAll(chosen)
    name = unused(docs, "_gone_")
    gone = stored(gone.select(F.struct(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).alias(name)), "gone")
    g = F.col(name)
    matches = same(F.col("doc_id").cast("long"), g.id) & (text_key(F.col("text")) == g.hash)
    kept = docs.join(small(gone, BROADCAST_ROWS), matches, "left_anti")
    if found.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():
        return kept
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return kept.where(has_words).dropDuplicates(["doc_id", "text"]).unionByName(kept.where(~has_words))
