"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import mapped, small, stored

ROUNDS = 60  # far above the logarithm of any number of nodes
TOGETHER = 250_000  # links a task contracts at a time


def components(links: DataFrame) -> DataFrame:
    """node and component, the smallest node it reaches, for every node of the links ``a``, ``b`` (of one type that has an order).

    ``links`` is read twice, so it should be a stored table. Up to ``TOGETHER`` links are contracted in one task, and that is all. Of
    more, tasks first replace those they hold by as few that join the same. Stars are then contracted in
    turns: each node hands its larger neighbours, then its smaller ones, to its smallest neighbour, until
    every link leads to a root. The links of each turn are written, so that a lost executor costs one turn.
    """
    kind = links.schema["a"].dataType.simpleString()
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    tasks = max(1, -(-links.count() // TOGETHER))
    links = mapped(links.coalesce(tasks), contract_batches, f"a {kind}, b {kind}").where("a > b")
    if tasks == 1:
        return _labels(stored(links, "links"))
    links = stored(links.distinct(), "links")
    before = _state(links)
    for _ in range(ROUNDS):
        large = stored(_towards_smallest(links.union(links.select("b", "a")), larger=True), "links")
        links = stored(_towards_smallest(large, larger=False), "links")
        state = _state(links)
        if state == before:
            return _labels(links)
        before = state
    raise RuntimeError("the components did not settle")


def _labels(links: DataFrame) -> DataFrame:
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def contract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links a, b -> for up to ``TOGETHER`` links at a time, each of their nodes with the smallest it reaches by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and sum(each.num_rows for each in held) + batch.num_rows > TOGETHER:
            yield contracted(held)
            held = []
        held.append(batch)
    if held:
        yield contracted(held)


def contracted(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(held)
    names = pa.concat_arrays([chunk for name in ("a", "b") for chunk in table[name].chunks])
    nodes = pc.unique(names)
    nodes = nodes.take(pc.sort_indices(nodes))
    codes = pc.index_in(names, nodes).to_numpy()
    root = list(range(len(nodes)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(codes[: len(codes) // 2].tolist(), codes[len(codes) // 2 :].tolist(), strict=True):
        i, j = find(i), find(j)
        root[max(i, j)] = min(i, j)
    roots = np.array([find(i) for i in range(len(nodes))], np.int64)
    return pa.RecordBatch.from_arrays([nodes, nodes.take(pa.array(roots))], names=["a", "b"])


def _state(links: DataFrame):
    return links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("all")).first()


def _clean(links: DataFrame) -> DataFrame:
    return links.where("a > b").distinct()


def _towards_smallest(links: DataFrame, larger: bool) -> DataFrame:
    """Link the neighbours ``b`` of each ``a``, larger or smaller ones, to the smallest of them all and ``a``.

    The smallest ones are written, and broadcast if they are few; else the join splits the links of a node that has very many.
    """
    smallest = stored(links.groupBy("a").agg(F.least("a", F.min("b")).alias("root")), "smallest")
    each = links.join(small(smallest), "a")
    if larger:
        moved = each.where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    else:
        own = smallest.select("a", F.col("root").alias("b"))
        moved = each.select(F.col("b").alias("a"), F.col("root").alias("b")).union(own)
    return _clean(moved)
