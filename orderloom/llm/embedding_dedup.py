"""Near-duplicate embeddings by NN-descent.

Each vector keeps a short list of its nearest neighbours of the same label. The lists start from
random-projection trees and improve by joins of neighbours with neighbours of neighbours, until
no list changes. A list that is full of links is saturated: its vector may have more, so
the list is enlarged to the whole connected component, whose pairs are counted tile by tile. Lists
of two vectors can both be full of nearer ones, so components with saturated lists are compared
with each other first, except where their balls are too far apart for any link. The
links that brute force finds for samples of vectors audit the recall, vector by vector; more trees
join while it is short, and if it stays short all pairs of a family are compared. All cosines are taken in double precision from the vectors as given.
"""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.graph import components
from orderloom.llm.work import Positions, discard, few, stage

COSINE = 0.98
#: Neighbours in a list.
NEIGHBOURS = 8
#: Trees at the start, and how many join after an audit that falls short.
TREES = 8
#: Vectors of a tree's leaf, about; a leaf of more than twice as many is split again around its mean.
LEAF = 64
#: Splits of a crowded leaf at most; what no projection parts by then is dealt out at random.
SPLITS = 4
#: Members that meet at one vector at once; more reverse neighbours meet in several groups.
MEETING = 64
#: Vectors of a tile's side.
TILE = 256
#: Balls that are compared with as many others at once.
BALLS = 1024
#: What is added to an angle for rounding.
SLACK = 1e-6
#: Vectors of each kind whose links brute force checks, about, the recall asked for, and attempts.
AUDITED = 512
RECALL = 0.995
ATTEMPTS = 3
SEED = 11

PAIRS = "u long, v long, cosine double"


def groups_of(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups from sorted batches, with the first row of each group and the end."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]) if held is not None else rows
        starts = changes(rows, keys)
        if len(starts) > 1:
            yield rows.slice(0, int(starts[-1])), starts
        held = rows.slice(int(starts[-1]))
    if held is not None:
        yield held, np.array([0, held.num_rows])


def changes(rows: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    """The rows at which a new group starts."""
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for key in keys:
        codes = rows.column(key).combine_chunks().dictionary_encode().indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def units(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """Unit vectors, one a row, of a column of packed vectors of one length."""
    raw = np.frombuffer(b"".join(column.to_pylist()), kind).astype(np.float64)
    rows = raw.reshape(len(column), -1)
    # Scaled first, so that very large or small components do not over- or underflow.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def packed_vector(numbers: list[float], kind: str) -> bytes:
    """The numbers as bytes, with one form of zero."""
    return (np.array(numbers, kind) + np.array(0, kind)).tobytes()


def classes_of(rows: DataFrame) -> tuple[DataFrame, str]:
    """(node, family, size, first_id, vec) of each distinct valid vector of a label, and the number
    type of ``vec``. Vectors of a family, one label and length, are compared. ``node`` is a number
    of the class's own, fixed once it is stored; ids of rows may repeat over classes."""
    element = rows.schema["embedding"].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    number = F.col("embedding")
    valid = (
        F.col("label").isNotNull()
        & (F.size(number) > 0)
        & F.forall(
            number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
        )
        & F.exists(number, lambda x: x != 0)
    )
    distinct = (
        rows.filter(valid)
        .groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("size"))
        .select(
            F.monotonically_increasing_id().alias("node"),
            F.concat_ws(":", "label", F.size("embedding")).alias("family"),
            "size",
            "first_id",
            "label",
            "embedding",
        )
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [packed_vector(v, kind) for v in batch.column(5).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(packed, pa.binary())],
                names=[*batch.schema.names[:5], "vec"],
            )

    label = rows.schema["label"].dataType.simpleString()
    schema = f"node long, family string, size long, first_id long, label {label}, vec binary"
    return stage(distinct.mapInArrow(pack, schema), "vector-classes"), kind


def from_leaves(classes: DataFrame, kind: str, first: int, trees: int, neighbours: int) -> DataFrame:
    """Pairs (u, v, cosine): the nearest neighbours within the leaves of some random-projection
    trees, numbered from ``first``. A tree's leaf is the signs of projections, as many as the
    family's size asks for; crowded leaves are split by further projections around their mean."""
    sizes = stage(classes.groupBy("family").agg(F.count("*").alias("n")), "family-sizes")
    depth = F.least(F.greatest(F.ceil(F.log2(F.col("n") / LEAF)), F.lit(0)), F.lit(30)).cast("int")
    rows = classes.join(few(sizes.select("family", depth.alias("depth"))), "family").select(
        "node", "family", "depth", "vec"
    )

    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            lengths = np.array([len(v) for v in batch.column(3).to_pylist()])
            for length in np.unique(lengths):
                at = pa.array(np.flatnonzero(lengths == length))
                part = batch.take(at)
                vectors = units(part.column(3), kind)
                bits = part.column(2).to_numpy()
                for tree in range(first, first + trees):
                    where = (vectors.shape[1], tree)
                    if where not in planes:
                        rng = np.random.default_rng([SEED, *where])
                        planes[where] = rng.standard_normal((vectors.shape[1], 30))
                    code = (vectors @ planes[where] > 0) @ (1 << np.arange(30, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0),
                            part.column(1),
                            pa.array(np.full(len(at), tree, np.int32)),
                            pa.array(code & ((1 << bits.astype(np.int64)) - 1)),
                        ],
                        names=["node", "family", "tree", "leaf"],
                    )

    leaves = stage(rows.mapInArrow(signs, "node long, family string, tree int, leaf long"), "leaves")
    for turn in range(SPLITS):
        crowded = crowded_leaves(leaves)
        if crowded.isEmpty():
            break
        following = split_leaves(leaves, crowded, classes, kind, turn)
        discard(leaves)
        leaves = following
    crowded = crowded_leaves(leaves).withColumn("shares", F.ceil(F.col("n") / LEAF)).drop("n")
    share = F.pmod(F.xxhash64("node", "tree"), F.coalesce("shares", F.lit(1)))
    dealt = (
        leaves.join(few(crowded), ["family", "tree", "leaf"], "left")
        .withColumn("share", share)
        .join(classes.select("node", "vec"), "node")
        .select("family", "tree", "leaf", "share", "node", "vec")
    )
    keys = ["family", "tree", "leaf", "share"]

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in groups_of(batches, *keys):
            nodes = table.column("node").to_numpy()
            out = [np.zeros((3, 0))]
            for a, b in zip(starts[:-1], starts[1:], strict=True) if len(starts) > 1 else []:
                out.append(top_pairs(nodes[a:b], units(table.column("vec").slice(a, b - a), kind)))
            yield pairs_batch(out)

    def top_pairs(nodes: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        cosines = vectors @ vectors.T
        np.fill_diagonal(cosines, -2.0)
        count = min(neighbours, len(nodes) - 1)
        if count < 1:
            return np.zeros((3, 0))
        top = np.argpartition(-cosines, count - 1, axis=1)[:, :count]
        u = np.repeat(np.arange(len(nodes)), count)
        return np.stack([nodes[u], nodes[top.ravel()], cosines[u, top.ravel()].view(np.int64)])

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(nearest, PAIRS)


def crowded_leaves(leaves: DataFrame) -> DataFrame:
    return stage(
        leaves.groupBy("family", "tree", "leaf")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > 2 * LEAF),
        "crowded-leaves",
    )


def split_leaves(
    leaves: DataFrame, crowded: DataFrame, classes: DataFrame, kind: str, turn: int
) -> DataFrame:
    """``leaves`` where each crowded one is parted by the signs of projections around its mean."""
    keys = ["family", "tree", "leaf"]
    rows = stage(
        leaves.join(few(crowded), keys).join(classes.select("node", "vec"), "node"), "crowded"
    )

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]).sort_by([(k, "ascending") for k in keys])
            starts = changes(table, tuple(keys))
            total = [
                units(table.column("vec").slice(a, b - a), kind).sum(axis=0).tolist()
                for a, b in zip(starts, [*starts[1:], table.num_rows], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *[table.column(k).take(pa.array(starts)).combine_chunks() for k in keys],
                    pa.array(total, pa.list_(pa.float64())),
                ],
                names=[*keys, "total"],
            )

    parts = rows.select(*keys, "vec").mapInArrow(
        sums, "family string, tree int, leaf long, total array<double>"
    )
    means = stage(
        parts.select(*keys, F.posexplode("total").alias("at", "x"))
        .groupBy(*keys, "at")
        .agg(F.sum("x").alias("x"))
        .groupBy(*keys)
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda p: p["x"]).alias("total")),
        "leaf-means",
    )

    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            trees, sizes = table.column("tree").to_numpy(), table.column("n").to_numpy()
            lengths = np.array([len(v) for v in table.column("vec").to_pylist()])
            code = np.zeros(len(lengths), np.int64)
            for length, tree in {*zip(lengths.tolist(), trees.tolist(), strict=True)}:
                at = np.flatnonzero((lengths == length) & (trees == tree))
                part = table.take(pa.array(at))
                vectors = units(part.column("vec"), kind)
                where = (vectors.shape[1], tree)
                if where not in planes:
                    rng = np.random.default_rng([SEED, *where, turn + 1])
                    planes[where] = rng.standard_normal((vectors.shape[1], 30))
                mean = np.array(part.column("total").to_pylist()) / sizes[at, None]
                bits = np.clip(np.ceil(np.log2(sizes[at] / LEAF)), 1, 30).astype(np.int64)
                signs = ((vectors - mean) @ planes[where] > 0) @ (1 << np.arange(30, dtype=np.int64))
                code[at] = signs & ((1 << bits) - 1)
            yield pa.RecordBatch.from_arrays(
                [*[table.column(k).combine_chunks() for k in ("node", *keys)], pa.array(code)],
                names=["node", *keys, "code"],
            )

    coded = rows.join(few(means, 2000), keys).select("node", *keys, "n", "vec", "total").mapInArrow(
        signs, "node long, family string, tree int, leaf long, code long"
    )
    out = stage(
        leaves.join(few(crowded.drop("n")), keys, "left_anti")
        .select("node", *keys)
        .union(coded.select("node", "family", "tree", F.xxhash64("leaf", "code").alias("leaf"))),
        "leaves",
    )
    discard(rows)
    return out


def pairs_batch(parts: list[np.ndarray]) -> pa.RecordBatch:
    """Pairs whose cosines are held as the bits of integers beside the nodes."""
    u, v, bits = np.concatenate([p.astype(np.int64) for p in parts], axis=1)
    return pa.RecordBatch.from_arrays(
        [pa.array(u), pa.array(v), pa.array(np.ascontiguousarray(bits).view(np.float64))],
        names=["u", "v", "cosine"],
    )


def best_lists(pairs: DataFrame, neighbours: int) -> DataFrame:
    """The ``neighbours`` nearest of each u; ``pairs(u, v, cosine, fresh)`` may repeat."""
    order = Window.partitionBy("u").orderBy(F.desc("cosine"), "v")
    return (
        pairs.groupBy("u", "v")
        .agg(F.max("cosine").alias("cosine"), F.min("fresh").alias("fresh"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= neighbours)
        .drop("rank")
    )


def met(lists: DataFrame, classes: DataFrame, kind: str, neighbours: int, turn: int) -> DataFrame:
    """Pairs that improve a list, from meetings of the neighbours and reverse neighbours of each
    vector, where one of the two is fresh."""
    ways = lists.select(F.col("u").alias("centre"), F.col("v").alias("member"), "fresh").union(
        lists.select(F.col("v").alias("centre"), F.col("u").alias("member"), "fresh")
    )
    meetings = ways.groupBy("centre", "member").agg(F.max("fresh").alias("fresh"))
    sizes = (
        meetings.groupBy("centre")
        .agg(F.count("*").alias("n"), F.max("fresh").alias("active"))
        .filter("active")
        .select("centre", F.ceil(F.col("n") / MEETING).alias("shares"))
    )
    worst = lists.groupBy(F.col("u").alias("member")).agg(
        F.when(F.count("*") >= neighbours, F.min("cosine")).otherwise(F.lit(-2.0)).alias("worst")
    )
    members = stage(
        meetings.join(sizes, "centre")
        .withColumn("share", F.pmod(F.xxhash64("member", F.lit(turn)), F.col("shares")))
        .drop("shares")
        .join(worst, "member", "left"),
        "meetings",
    )
    keys = ["centre", "share"]
    rows = members.join(classes.select(F.col("node").alias("member"), "vec"), "member")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in groups_of(batches, *keys):
            nodes = table.column("member").to_numpy()
            fresh = table.column("fresh").to_numpy()
            limit = np.nan_to_num(table.column("worst").to_numpy(), nan=-2.0)
            vectors = units(table.column("vec"), kind) if same_length(table) else None
            out = [np.zeros((3, 0))]
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                if b - a < 2 or not fresh[a:b].any():
                    continue
                own = units(table.column("vec").slice(a, b - a), kind) if vectors is None else vectors[a:b]
                cosines = own @ own.T
                better = (cosines > limit[a:b, None]) & (fresh[a:b, None] | fresh[None, a:b])
                np.fill_diagonal(better, False)
                u, v = np.nonzero(better)
                out.append(np.stack([nodes[a + u], nodes[a + v], cosines[u, v].view(np.int64)]))
            yield pairs_batch(out)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(join, PAIRS)


def same_length(table: pa.Table) -> bool:
    lengths = {len(v) for v in table.column("vec").to_pylist()}
    return len(lengths) == 1


def neighbour_lists(
    classes: DataFrame, kind: str, start: DataFrame | None, first: int, trees: int, neighbours: int
) -> DataFrame:
    """Lists after the descent, from the lists of ``start`` and some new trees."""
    pairs = from_leaves(classes, kind, first, trees, neighbours).withColumn("fresh", F.lit(True))
    if start is not None:
        pairs = pairs.union(start.withColumn("fresh", F.lit(False)))
    lists = stage(best_lists(pairs, neighbours), "lists")
    for turn in count():
        if lists.filter("fresh").isEmpty():
            break
        found = met(lists, classes, kind, neighbours, turn).withColumn("fresh", F.lit(True))
        following = stage(
            best_lists(lists.withColumn("fresh", F.lit(False)).union(found), neighbours), "lists"
        )
        discard(lists)
        lists = following
    return lists


def tile_counts(members: DataFrame, kind: str, cosine: float) -> DataFrame:
    """(node, linked): the sizes of all classes that each node of ``members(component, node, size,
    vec)`` is linked with in its component."""
    return tiled(members, kind, cosine).groupBy("node").agg(F.sum("linked").alias("linked"))


def forest(links: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix, the row it is reached from; its own for a first one."""
    reached_from = np.full(len(links), -1)
    for first in range(len(links)):
        if reached_from[first] >= 0:
            continue
        reached_from[first], todo = first, [first]
        while todo:
            at = todo.pop()
            new = np.flatnonzero(links[at] & (reached_from < 0))
            reached_from[new] = at
            todo += new.tolist()
    return reached_from


def tiled(members: DataFrame, kind: str, cosine: float) -> DataFrame:
    """(node, linked, other) for each node and tile: the sizes of the classes it is linked with,
    and one of them, such that these links connect all that the tile's links connect. Every pair
    of blocks is one tile; tiles give a row a node, no pairs."""
    blocks = F.ceil(F.col("n") / TILE)
    sizes = stage(members.groupBy("component").agg(F.count("*").alias("n")), "component-sizes")
    dealt = members.join(few(sizes), "component").withColumn(
        "block", F.pmod(F.xxhash64("node"), blocks)
    )
    tiles = dealt.select(
        "component",
        "node",
        "size",
        "block",
        "vec",
        F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"),
    ).select(
        "component",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block",
        "node",
        "size",
        "vec",
    )
    keys = ["component", "low", "high"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in groups_of(batches, *keys):
            block, low = (table.column(c).to_numpy() for c in ("block", "low"))
            high, size = (table.column(c).to_numpy() for c in ("high", "size"))
            nodes = table.column("node").to_numpy()
            linked = np.zeros(table.num_rows, np.int64)
            other = np.zeros(table.num_rows, np.int64)
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                own = units(table.column("vec").slice(a, b - a), kind)
                links = own @ own.T >= cosine
                np.fill_diagonal(links, False)
                if low[a] != high[a]:
                    links &= block[a:b, None] != block[None, a:b]
                linked[a:b] = links @ size[a:b]
                other[a:b] = nodes[a:b][forest(links)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(linked), pa.array(other)],
                names=["node", "linked", "other"],
            )

    return tiles.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        count, "node long, linked long, other long"
    )


def all_links(classes: DataFrame, kind: str, cosine: float) -> tuple[DataFrame, DataFrame]:
    """What ``link_counts`` gives, from all pairs of each family, in tiles."""
    members = classes.select(F.col("family").alias("component"), "node", "size", "vec")
    rows = stage(tiled(members, kind, cosine), "all-tiles")
    edges = rows.filter("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b"))
    found = stage(components(edges.distinct()), "vector-components")
    counted = rows.groupBy("node").agg(F.sum("linked").alias("linked")).filter("linked > 0")
    return stage(counted, "link-counts"), found


def cross_links(members: DataFrame, kind: str, cosine: float) -> DataFrame:
    """(a, b): links between the components of ``members(component, node, family, vec)``, one or
    more for each two components that are linked.

    Components are dealt into pieces, each inside a ball around its mean direction. By the
    triangle inequality of angles, pieces whose balls are further apart than the angle of
    ``cosine`` have no link; all others are compared vector by vector, one tile a pair of pieces.
    """
    sizes = stage(members.groupBy("component").agg(F.count("*").alias("n")), "dense-sizes")
    pieces = stage(
        members.join(few(sizes), "component").select(
            "family",
            "component",
            F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / TILE)).alias("share"),
            "node",
            "vec",
        ),
        "pieces",
    )
    keys = ["family", "component", "share"]

    def ball(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in groups_of(batches, *keys):
            centres, radii = [], []
            for a, b in zip(starts[:-1], starts[1:], strict=True) if len(starts) > 1 else []:
                own = units(table.column("vec").slice(a, b - a), kind)
                centre = own.sum(axis=0)
                if not centre.any():
                    centre = own[0]
                centre = centre / np.sqrt(centre @ centre)
                centres.append(centre.tobytes())
                radii.append(float(np.arccos(np.clip(own @ centre, -1, 1)).max()))
            first = pa.array(starts[:-1]) if len(starts) > 1 else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *[table.column(k).take(first).combine_chunks() for k in keys],
                    pa.array(centres, pa.binary()),
                    pa.array(radii, pa.float64()),
                ],
                names=[*keys, "centre", "radius"],
            )

    balls = stage(
        pieces.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(
            ball, "family string, component long, share long, centre binary, radius double"
        ),
        "balls",
    )
    blocks = F.ceil(F.col("n") / BALLS)
    spread = stage(balls.groupBy("family").agg(F.count("*").alias("n")), "ball-counts")
    dealt = balls.join(few(spread), "family").withColumn(
        "block", F.pmod(F.xxhash64("component", "share"), blocks)
    )
    side = ["family", "low", "high"]
    sides = dealt.withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    ).select(
        "family",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block",
        "component",
        "share",
        "centre",
        "radius",
    )
    reach = float(np.arccos(min(1.0, max(-1.0, cosine)))) + SLACK

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in groups_of(batches, *side):
            component, share = (table.column(c).to_numpy() for c in ("component", "share"))
            block, radius = (table.column(c).to_numpy() for c in ("block", "radius"))
            low, high = (table.column(c).to_numpy() for c in ("low", "high"))
            for a, b in zip(starts[:-1], starts[1:], strict=True) if len(starts) > 1 else []:
                centres = np.frombuffer(
                    b"".join(table.column("centre").slice(a, b - a).to_pylist()), np.float64
                ).reshape(b - a, -1)
                angles = np.arccos(np.clip(centres @ centres.T, -1, 1))
                near = angles <= radius[a:b, None] + radius[None, a:b] + reach
                near &= component[a:b, None] < component[None, a:b]
                if low[a] != high[a]:
                    near &= block[a:b, None] != block[None, a:b]
                x, y = np.nonzero(near)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column[a + i]) for i in (x, y) for column in (component, share)],
                    names=["c1", "s1", "c2", "s2"],
                )

    pairs = stage(
        sides.repartition(*side)
        .sortWithinPartitions(*side)
        .mapInArrow(close, "c1 long, s1 long, c2 long, s2 long"),
        "close-balls",
    )
    tile = ["c1", "s1", "c2", "s2"]
    own = pieces.select("component", "share", "node", "vec")
    rows = pairs.join(
        own.select(F.col("component").alias("c1"), F.col("share").alias("s1"), "node", "vec"),
        ["c1", "s1"],
    ).select(*tile, F.lit(True).alias("left"), "node", "vec").union(
        pairs.join(
            own.select(F.col("component").alias("c2"), F.col("share").alias("s2"), "node", "vec"),
            ["c2", "s2"],
        ).select(*tile, F.lit(False).alias("left"), "node", "vec")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in groups_of(batches, *tile):
            nodes = table.column("node").to_numpy()
            left = table.column("left").to_numpy()
            out: list[tuple[int, int]] = []
            for a, b in zip(starts[:-1], starts[1:], strict=True) if len(starts) > 1 else []:
                vectors = units(table.column("vec").slice(a, b - a), kind)
                one, two = left[a:b], ~left[a:b]
                cosines = vectors[one] @ vectors[two].T
                if cosines.size and cosines.max() >= cosine:
                    x, y = np.unravel_index(int(cosines.argmax()), cosines.shape)
                    out.append((int(nodes[a:b][one][x]), int(nodes[a:b][two][y])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    found = stage(
        rows.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(compare, "a long, b long"),
        "cross-links",
    )
    for used in (pieces, balls, pairs):
        discard(used)
    return found


def link_counts(
    lists: DataFrame, classes: DataFrame, kind: str, neighbours: int, cosine: float
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(node, linked) of nodes with links, (node, component) of the same nodes, and (component) of
    those with a full list."""
    linked = lists.filter(F.col("cosine") >= cosine)
    edges = stage(
        linked.select(F.col("u").alias("a"), F.col("v").alias("b"))
        .union(linked.select(F.col("v").alias("a"), F.col("u").alias("b")))
        .distinct(),
        "links",
    )
    found = stage(components(edges), "vector-components")
    saturated = stage(
        linked.groupBy("u").count().filter(F.col("count") >= neighbours).select("u"), "saturated"
    )

    def with_saturated() -> DataFrame:
        return stage(
            found.join(saturated, F.col("node") == F.col("u"), "left_semi")
            .select("component")
            .distinct(),
            "dense-components",
        )

    dense = with_saturated()
    across = cross_links(
        found.join(few(dense), "component", "left_semi").join(
            classes.select("node", "family", "vec"), "node"
        ),
        kind,
        cosine,
    )
    if not across.isEmpty():
        found = stage(components(edges.union(across)), "vector-components")
        dense = with_saturated()
    inside = found.join(few(dense), "component", "left_semi")
    outside = found.join(few(dense), "component", "left_anti")
    sizes = classes.select("node", "size")
    listed = (
        edges.join(outside, F.col("a") == F.col("node"), "left_semi")
        .join(sizes, F.col("b") == F.col("node"))
        .groupBy(F.col("a").alias("node"))
        .agg(F.sum("size").alias("linked"))
    )
    counted = tile_counts(
        inside.join(classes.select("node", "size", "vec"), "node"), kind, cosine
    )
    return stage(listed.union(counted), "link-counts"), found, dense


def recall(
    counts: DataFrame,
    found: DataFrame,
    dense: DataFrame,
    classes: DataFrame,
    kind: str,
    cosine: float,
) -> float:
    """Share of the vectors with a link of which every link was found, by brute force for bounded
    samples of three kinds of vectors: in components with a full list, in others, and those of
    which no link was found. Vectors of the last two kinds are one population, as small groups
    would vanish beside large ones; the smaller share counts."""
    dense_node = F.col("dense").isNotNull()
    kinds = stage(
        classes.select("node", "family", "vec")
        .join(found, "node", "left")
        .join(few(dense.withColumn("dense", F.lit(True))), "component", "left")
        .select(
            "node",
            "family",
            "vec",
            F.when(dense_node, 0).when(F.col("component").isNotNull(), 1).otherwise(2).alias("sort"),
        ),
        "audit-kinds",
    )
    totals = {r["sort"]: r["count"] for r in kinds.groupBy("sort").count().collect()}
    part = F.pmod(F.xxhash64("node"), F.lit(1 << 30))
    share = F.lit(0)
    for sort, n in totals.items():
        limit = int(min(1.0, AUDITED / n) * (1 << 30))
        share = F.when(F.col("sort") == sort, F.lit(limit)).otherwise(share)
    sample = kinds.filter(part < share).select("node", "family", "vec", "sort").collect()
    discard(kinds)
    sorts = {row["node"]: row["sort"] for row in sample}
    queries: dict[tuple[str, int], list] = {}
    for node, family, vec, _ in sample:
        queries.setdefault((family, len(vec)), []).append((node, bytes(vec)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            families = np.array(table.column("family").to_pylist(), object)
            nodes, size = table.column("node").to_numpy(), table.column("size").to_numpy()
            for (family, _), wanted in queries.items():
                at = np.flatnonzero(families == family)
                if not len(at):
                    continue
                names = np.array([n for n, _ in wanted])
                asked = units(pa.chunked_array([pa.array([v for _, v in wanted])]), kind)
                near = asked @ units(table.column("vec").take(pa.array(at)), kind).T >= cosine
                near &= names[:, None] != nodes[None, at]
                for name, n in zip(names.tolist(), (near @ size[at]).tolist(), strict=True):
                    seen[name] = seen.get(name, 0) + n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())],
            names=["node", "n"],
        )

    truth = (
        classes.select("node", "family", "size", "vec")
        .mapInArrow(count, "node long, n long")
        .groupBy("node")
        .agg(F.sum("n").alias("n"))
    )
    linked = {0: 0, 1: 0, 2: 0}
    whole = {0: 0, 1: 0, 2: 0}
    for row in truth.filter("n > 0").join(counts, "node", "left").collect():
        linked[sorts[row["node"]]] += 1
        whole[sorts[row["node"]]] += row["linked"] == row["n"]
    seen = Counter(sorts.values())

    def estimated(part: dict[int, int], sort: int) -> float:
        return part[sort] * totals.get(sort, 0) / max(1, seen[sort])

    inside = whole[0] / linked[0] if linked[0] else 1.0
    beside = estimated(linked, 1) + estimated(linked, 2)
    return min(inside, estimated(whole, 1) / beside if beside else 1.0)


def near_duplicates(
    vectors: DataFrame,
    cosine: float = COSINE,
    neighbours: int = NEIGHBOURS,
    report: Callable[[float], None] | None = None,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors(vec_id, embedding, label)``.

    ``n_links`` counts the other rows linked directly: of the same label and length, with a cosine
    of ``cosine`` or more. ``component_id`` is the smallest vec_id reachable by links, and ``kept``
    tells whether it is the row's own. Rows whose label or vector is null, whose vector is empty,
    zero or holds a null or non-finite number link with nothing and are their own component.
    Equal vectors of a label are one class before anything is compared, so copies, repeated rows
    among them, are never paired. Different vectors under one vec_id are rows of their own, which may
    link with each other. Rows without a vec_id are never the smallest. ``report`` gets the
    audited recall of each attempt, and 1 after all pairs were compared. An empty table gives no rows.
    """
    given = Positions(vectors).pick("vec_id", "embedding", "label")
    classes, kind = classes_of(given)
    lists, counts, found = None, None, None
    for attempt in range(ATTEMPTS):
        lists = neighbour_lists(classes, kind, drop_fresh(lists), attempt * TREES, TREES, neighbours)
        counts, found, dense = link_counts(lists, classes, kind, neighbours, cosine)
        audited = recall(counts, found, dense, classes, kind, cosine)
        if report:
            report(audited)
        if audited >= RECALL:
            break
        logging.getLogger(__name__).warning("recall %.4f after %d trees", audited, (attempt + 1) * TREES)
    else:
        counts, found = all_links(classes, kind, cosine)
        if report:
            report(1.0)
    labelled = (
        classes.join(found, "node", "left")
        .join(counts, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    smallest = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    results = stage(
        labelled.join(smallest, "component").select(
            F.col("node"),
            (F.coalesce("linked", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            "component_id",
        ),
        "vector-labels",
    )
    keyed = classes.join(results, "node").select(
        F.col("label").alias("class_label"), "vec", "n_links", "component_id"
    )
    return with_labels(given, keyed, kind)


def drop_fresh(lists: DataFrame | None) -> DataFrame | None:
    return None if lists is None else lists.drop("fresh")


def with_labels(given: DataFrame, keyed: DataFrame, kind: str) -> DataFrame:
    """Every row of ``given`` with the results of its class."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [
                None if v is None or None in v else packed_vector(v, kind)
                for v in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(packed, pa.binary())],
                names=["vec_id", "label", "packed"],
            )

    ids, label = (given.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    rows = given.mapInArrow(pack, f"vec_id {ids}, label {label}, packed binary")
    joined = rows.join(
        keyed,
        (F.col("label") == F.col("class_label")) & (F.col("packed") == F.col("vec")),
        "left",
    )
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
