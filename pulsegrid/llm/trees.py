"""Embedding near-dedup with a forest of random-projection trees.

Each of ``TREES`` trees splits the vectors at a random projection, at the median or, if too many vectors lie within
``SPILL`` of it, at another place between the quarters; vectors within ``SPILL`` of a split go to both sides. Where no
place parts a node, as in a bundle of near copies, the node goes down whole and the next direction is tried. The splits
are fitted on a sample chosen by a hash, and every vector is sent down them. The vectors of a label in a leaf are dealt
into blocks of about ``BLOCK`` rows, and each two blocks are compared exactly in a task of their own; a bundle of any
size is many such tasks. Pairs are counted where they are found, not listed: a pair counts in the first leaf its vectors
share, which the leaves each row carries tell, and of the links in two blocks only a star per component goes on. Equal
vectors of a label are one member with a count and are not compared. Components follow from the stars.

Vectors that are null, empty, zero, of another length than most, or hold null or non-finite components, and rows with
a null label or id, link with nothing: no links, and their own component. Rows with the same id are vectors of their
own. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.ann import matrix, sound
from pulsegrid.llm.components import components
from pulsegrid.sources.scratch import cut

TREES = 6
#: Distance from a split up to which a vector of length one goes to both sides.
SPILL = 0.025
#: Vectors the splits are fitted on, and for each leaf at least; levels of halving, and levels beside those for nodes
#: that a direction can't part.
SAMPLE, LEAF_SAMPLE, DEPTH, MORE = 20_000, 16, 14, 6
#: Largest share of a node near a split, and the places tried, the median first.
NEAR, PLACES = 0.25, (0.5, 0.44, 0.56, 0.38, 0.62, 0.31, 0.69, 0.25, 0.75)
#: Vectors of a leaf, and of a label in memory that ``compare`` takes without splits.
LEAF, COMPARE = 2048, 1024
#: Rows of a block, and rows compared at once.
BLOCK, STRIP = 2048, 512


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def plant(sample: np.ndarray, levels: int, seed: int, most: float) -> list[tuple[np.ndarray, ...]]:
    """Per level: a direction for all its nodes, and each node's split and its numbers below and above on the next
    level. A node of up to ``most`` rows, or one that the direction can't part, has an infinite split: all go below."""
    random = np.random.default_rng(seed)
    node, nodes = np.zeros(len(sample), np.int64), 1
    found = []
    for _ in range(levels):
        direction = random.standard_normal(sample.shape[1])
        direction /= np.sqrt(direction @ direction)
        on = sample @ direction
        order = np.lexsort((on, node))
        edges = np.r_[0, np.cumsum(np.bincount(node, minlength=nodes))]
        if np.diff(edges).max() <= most:
            break
        split = np.full(nodes, np.inf)
        for k in range(nodes):
            own = on[order[edges[k] : edges[k + 1]]]
            if len(own) > most:
                at = own[[int(p * len(own)) for p in PLACES]]
                near = np.searchsorted(own, at + SPILL, "right") - np.searchsorted(own, at - SPILL)
                fine = np.flatnonzero(near <= NEAR * len(own))
                if len(fine):
                    split[k] = at[fine[0]]
        parted = split < np.inf
        below = np.arange(nodes) + np.cumsum(parted) - parted
        above = below + parted
        found.append((direction, split, below, above))
        node, nodes = np.where(on >= split[node], above[node], below[node]), nodes + int(parted.sum())
    return found


def route(vectors: np.ndarray, levels: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the leaves they are in, a row in several leaves if it is near splits."""
    row, node = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
    for direction, split, below, above in levels:
        off = (vectors @ direction)[row] - split[node]
        under, over = off < SPILL, off >= -SPILL
        row, node = np.r_[row[under], row[over]], np.r_[below[node[under]], above[node[over]]]
    return row, node


def routed(vectors: np.ndarray, trees: list) -> tuple[np.ndarray, np.ndarray]:
    """Rows and leaves of all trees, by row and leaf; leaves are numbered through the trees."""
    rows, leaves, base = [], [], 0
    for levels in trees:
        row, node = route(vectors, levels)
        rows.append(row)
        leaves.append(node + base)
        base += int(levels[-1][3][-1]) + 1 if levels else 1
    row, leaf = np.concatenate(rows), np.concatenate(leaves)
    order = np.lexsort((leaf, row))
    return row[order], leaf[order]


def compare(vectors: np.ndarray, least: float, random: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows in memory with at least that cosine; many rows are split on before they are compared."""
    if len(vectors) > COMPARE:
        direction = random.standard_normal(vectors.shape[1])
        on = vectors @ (direction / np.sqrt(direction @ direction))
        split = np.median(on)
        sides = [np.flatnonzero(on < split + SPILL), np.flatnonzero(on >= split - SPILL)]
        # A bundle that a split can't part any more is compared as it is.
        if max(map(len, sides)) < 0.9 * len(vectors):
            for side in sides:
                for a, b in compare(vectors[side], least, random):
                    yield side[a], side[b]
            return
    for k in range(0, len(vectors), STRIP):
        a, b = np.nonzero(vectors[k : k + STRIP] @ vectors[k:].T >= least)
        yield a[a < b] + k, b[a < b] + k


def _sizes(batches: Iterator[pa.RecordBatch], trees: list) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, leaf = routed(unit(matrix(batch.column("vec"))), trees)
        yield pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int32)), batch.column("label").take(pa.array(row))], names=["leaf", "label"])


def _dealt(batches: Iterator[pa.RecordBatch], trees: list, blocks: dict[tuple[int, int], int]) -> Iterator[pa.RecordBatch]:
    """Each row once for every two blocks of a leaf that it is compared in; ``blocks`` has the leaves of several."""
    for whole in batches:
        for at in range(0, whole.num_rows, STRIP):
            batch = whole.slice(at, STRIP)
            row, leaf = routed(unit(matrix(batch.column("vec"))), trees)
            labels, dealt = batch.column("label").to_numpy(), batch.column("dealt").to_numpy()
            edges = np.searchsorted(row, np.arange(batch.num_rows + 1))
            own = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(leaf, pa.int32()))
            n = np.array([blocks.get(x, 1) for x in zip(leaf.tolist(), labels[row].tolist(), strict=True)], np.int64)
            block = dealt[row] % n
            again = np.repeat(np.arange(len(row)), n)
            other = np.arange(len(again)) - np.repeat(np.cumsum(n) - n, n)
            # So many copies at once as make a batch.
            for k in range(0, len(again), 8 * STRIP):
                some, b = again[k : k + 8 * STRIP], other[k : k + 8 * STRIP]
                mine, take = block[some], pa.array(row[some])
                kept = [batch.column(c).take(take) for c in ("label", "key", "node", "copies", "vec")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf[some].astype(np.int32)), *(pa.array(x.astype(np.int32)) for x in (np.minimum(mine, b), np.maximum(mine, b), mine)), own.take(take), *kept],
                    names=["leaf", "lo", "hi", "block", "leaves", "label", "key", "node", "copies", "vec"],
                )


def _earlier(leaves: pa.ListArray, leaf: int) -> np.ndarray:
    """Whether each two rows share a leaf before this one."""
    row = np.repeat(np.arange(len(leaves)), np.diff(leaves.offsets.to_numpy()))
    flat = leaves.flatten().to_numpy()
    row, flat = row[flat < leaf], flat[flat < leaf]
    names, column = np.unique(flat, return_inverse=True)
    member = np.zeros((len(leaves), len(names)), np.float32)
    member[row, column] = 1
    return member @ member.T > 0


def _links(rows: pa.Table, least: float) -> pa.Table:
    """Rows' links that no earlier leaf has counted, weighted by copies, and a link to the first of their component."""
    vectors, block = unit(matrix(rows["vec"])), rows["block"].to_numpy()
    leaf, lo, hi = (rows[c][0].as_py() for c in ("leaf", "lo", "hi"))
    copies, node = rows["copies"].to_numpy(), rows["node"].to_numpy()
    near = np.zeros((len(rows), len(rows)), bool)
    for k in range(0, len(rows), STRIP):
        near[k : k + STRIP] = vectors[k : k + STRIP] @ vectors.T >= least
    # Both sides of a pair see the same product.
    near |= near.T
    np.fill_diagonal(near, False)
    if lo != hi:
        near &= block[:, None] != block[None]
    at = np.flatnonzero(near.any(axis=1))
    near = near[np.ix_(at, at)]
    leaves = rows["leaves"].combine_chunks()
    leaves = (leaves.chunk(0) if isinstance(leaves, pa.ChunkedArray) else leaves).take(pa.array(at))
    linked = np.zeros(len(at), np.int64)
    first, seen = np.arange(len(at)), np.zeros(len(at), bool)
    if len(at):
        new = near & ~_earlier(leaves, leaf)
        for k in range(0, len(at), STRIP):
            linked[k : k + STRIP] = np.where(new[k : k + STRIP], copies[at][None], 0).sum(axis=1)
    for k in range(len(at)):
        front = np.array([] if seen[k] else [k], np.int64)
        seen[k] = True
        while len(front):
            first[front] = k
            front = np.flatnonzero(near[front].any(axis=0) & ~seen)
            seen[front] = True
    return pa.table({"key": rows["key"].take(pa.array(at)), "linked": linked, "a": node[at], "b": node[at[first]]})


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", least: float = 0.93) -> DataFrame:
    """``id_col``, ``n_links``, ``component_id``, ``kept``, one row per row of ``vectors``."""
    whole = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"), F.col(label_col).alias("label"))
    part = F.col("id").isNotNull() & F.col("label").isNotNull() & sound(F.col("vec"))
    # Equal vectors of a label share a key of 256 bits; -0.0 is 0.0 there.
    text = F.to_json(F.struct("label", F.transform("vec", lambda x: x + F.lit(0).cast("float")).alias("vec")))
    key = F.when(part, F.sha2(text, 256))
    rows = cut(whole.withColumn("key", key), "embeddings")
    fine = rows.where("key IS NOT NULL")
    dims = fine.groupBy(F.size("vec").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    fine = fine.where(F.size("vec") == (dims["dims"] if dims else 0))
    members = fine.groupBy("key").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
    first = fine.join(members, "key").where("id = node").groupBy("key").agg(F.first("node").alias("node"), F.first("label").alias("label"), F.first("vec").alias("vec"))
    first = first.join(members.select("key", "copies"), "key")
    first = cut(first.select("key", "node", "copies", F.xxhash64(F.col("label").cast("string")).alias("label"), "vec"), "members")
    n = first.count()
    depth = max(0, min(int(np.ceil(np.log2(max(n, 1) / LEAF))), DEPTH))
    trees = [[] for _ in range(TREES if depth else 1)]
    if depth:
        sample = unit(matrix(first.select("vec").orderBy(F.xxhash64("key"), "key").limit(max(SAMPLE, LEAF_SAMPLE << depth)).toArrow()["vec"]))
        trees = [plant(sample, depth + MORE, seed, len(sample) / (1 << depth)) for seed in range(TREES)]
    # Leaves of more than a block, one row per block at least.
    sizes = first.mapInArrow(lambda b: _sizes(b, trees), "leaf int, label long").groupBy("leaf", "label").count().where(F.col("count") > BLOCK)
    blocks = {(r["leaf"], r["label"]): -(-r["count"] // BLOCK) for r in sizes.collect()}
    types = {c: first.schema[c].dataType.simpleString() for c in ("key", "node", "vec")}
    dealt = first.withColumn("dealt", F.pmod(F.xxhash64("key"), F.lit(1 << 31)))
    dealt = dealt.mapInArrow(lambda b: _dealt(b, trees, blocks), f"leaf int, lo int, hi int, block int, leaves array<int>, label long, key string, node {types['node']}, copies long, vec {types['vec']}")
    links = dealt.groupBy("leaf", "label", "lo", "hi").applyInArrow(lambda t: _links(t, least), f"key string, linked long, a {types['node']}, b {types['node']}")
    links = cut(links, "links")
    linked = links.groupBy("key").agg(F.sum("linked").alias("linked"))
    links = links.select("a", "b").where("a <> b")
    found = components(links, "embedding-links")
    named = members.join(linked, "key", "left").join(found, "node", "left")
    named = named.select("key", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    out = rows.select("id", "key").join(named, "key", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
