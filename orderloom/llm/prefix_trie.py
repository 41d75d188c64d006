"""The prefix trie of conversations, with subtree totals by time-forward processing.

1. Conversations stream through tasks in order; each prefix gets a chained hash of its turns.
2. Equal prefixes are one node. A node is *heavy* if more prefixes lie below it than a shard takes;
   the topmost other nodes are the roots of the shards.
3. Within the shards, nodes are sorted deepest level first. Each takes the totals that its children
   sent from a priority queue that spills to disk, and sends its own to its parent.
4. The totals of shard roots are summed by parent, and the heavy nodes are processed the same way.
"""

from __future__ import annotations

import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.work import discard, few, stage

#: Prefixes below a shard root at most, as long as that makes no more shards than ``MAX_SHARDS``.
SHARD_PREFIXES = 20_000
MAX_SHARDS = 20_000
#: Messages that a queue keeps in memory.
QUEUE_MESSAGES = 200_000

#: Rows a task hands on at once.
_BATCH_ROWS = 10_000


def turn_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, chars) of ``turns(conv_id, turn, role, text)``; null texts and
    roles are empty. The text itself goes no further."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(said, 256)).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )


class _Batches:
    """Rows collected into record batches of a schema."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows = schema, []

    def add(self, row: tuple) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        if len(self.rows) >= _BATCH_ROWS:
            yield self.taken()

    def taken(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(self.schema)
        self.rows = []
        made = [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)]
        return pa.record_batch(made, schema=self.schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns], strict=True)


_PREFIX = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("depth", pa.int64()),
        ("key", pa.binary()),
        ("parent", pa.binary()),
        ("chars", pa.int64()),
        ("is_end", pa.bool_()),
    ]
)
_ROOT = sha256(b"").digest()[:16]


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes of conversations that come turn by turn, each after the leader of its group."""
    out = _Batches(_PREFIX)
    leader, heads, conv = None, [], None
    path: tuple | None = None
    for group, conv_id, digest, chars, borrowed in _rows(batches):
        if group != leader:
            leader, heads = group, []
        if conv != (group, conv_id):
            if path:
                yield from out.add((*path, True))
            conv, seen = (group, conv_id), 0
            path = (conv_id, 0, _ROOT, None, 0)
            for head in heads[:borrowed] if conv_id != group else []:
                yield from out.add((*path, False))
                path = _next(path, *head)
        seen += 1
        if conv_id == group and len(heads) < MOST_BORROWED:
            heads.append((digest, chars))
        if conv_id == group or seen > borrowed:
            yield from out.add((*path, False))
            path = _next(path, digest, chars)
    if path:
        yield from out.add((*path, True))
    yield out.taken()


#: Turns that a conversation may take from its leader.
MOST_BORROWED = 16


def _next(path: tuple, digest: bytes, chars: int) -> tuple:
    conv_id, depth, key, _, _ = path
    return conv_id, depth + 1, sha256(key + digest).digest()[:16], key, chars


def prefixes(digests: DataFrame, group: str = "conv_id", borrowed: str = "0") -> DataFrame:
    """(conv_id, depth, key, parent, chars, is_end): every prefix of every conversation.

    ``digests`` comes from ``turn_digests``. The SQL expression ``group`` names the leader of a
    conversation, which gives its first turns in place of as many own ones: ``borrowed``, at most
    ``MOST_BORROWED``. A leader without rows gives none. The conversations of one leader stream
    through one task, in constant memory.
    """
    placed = digests.select(
        F.expr(group).alias("leader"), "conv_id", "turn", "digest", "chars", F.expr(borrowed).alias("borrowed")
    )
    return (
        placed.repartition("leader")
        .sortWithinPartitions(
            "leader", F.col("conv_id") != F.col("leader"), "conv_id", F.col("turn").asc_nulls_first(), "digest"
        )
        .select("leader", "conv_id", "digest", "chars", "borrowed")
        .mapInArrow(
            _chain,
            "conv_id long, depth long, key binary, parent binary, chars long, is_end boolean",
        )
    )


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Batches(pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())]))
    last, running = None, None
    for key, conv_id in _rows(batches):
        if key == last:
            running.update(b",%d" % conv_id)
            continue
        if last is not None:
            yield from out.add((last, running.hexdigest()))
        last, running = key, sha256(b"%d" % conv_id)
    if last is not None:
        yield from out.add((last, running.hexdigest()))
    yield out.taken()


class SpillingQueue:
    """A priority queue of messages that keeps ``most`` of them in memory.

    Beyond that, the messages held are sorted and written to a file of this task, and read back
    in order when their turn comes.
    """

    def __init__(self, most: int = QUEUE_MESSAGES):
        self.most, self.heap, self.runs, self.files = most, [], [], []

    def push(self, message: tuple) -> None:
        if len(self.heap) >= self.most:
            self._spill()
        heapq.heappush(self.heap, message)

    def pop_all(self, priority: tuple) -> Iterator[tuple]:
        """Messages whose first fields are ``priority``; call in increasing order of it."""
        size = len(priority)
        while self.heap and self.heap[0][:size] == priority:
            yield heapq.heappop(self.heap)
        while self.runs and self.runs[0][0][:size] == priority:
            message, number = heapq.heappop(self.runs)
            self._advance(number)
            yield message

    def _spill(self) -> None:
        where = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        file = tempfile.TemporaryFile(dir=where)
        for message in sorted(self.heap):
            pickle.dump(message, file, pickle.HIGHEST_PROTOCOL)
        file.seek(0)
        self.heap = []
        self.files.append(file)
        self._advance(len(self.files) - 1)

    def _advance(self, number: int) -> None:
        try:
            heapq.heappush(self.runs, (pickle.load(self.files[number]), number))
        except EOFError:
            self.files[number].close()


_TOTALS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
_NODE = pa.schema(
    [(n, pa.binary()) for n in ("key", "parent")]
    + [(n, pa.int64()) for n in ("conv_id", "depth", "parent_conv_id", *_TOTALS)]
    + [("is_top", pa.bool_())]
)
_NODE_TYPE = "key binary, parent binary, " + "".join(
    f"{n} long, " for n in ("conv_id", "depth", "parent_conv_id", *_TOTALS)
) + "is_top boolean"


def _forward(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Subtree totals of nodes that come deepest first, then by key.

    Each node's row rides in the message to its parent, which adds its totals and names itself in
    it. Nodes whose parent is not among the rows (``is_top``) leave without a parent's name.
    ``children``, ``leaves`` and ``saved`` are what nodes outside the rows have sent already.
    """
    queue, out = SpillingQueue(most), _Batches(_NODE)
    for key, parent, conv_id, depth, n_convs, own_saved, children, leaves, saved, is_top in _rows(batches):
        saved += own_saved
        for _, _, child in queue.pop_all((-depth, key)):
            yield from out.add((*child[:4], conv_id, *child[4:], False))
            children, leaves, saved = children + 1, leaves + child[6], saved + child[7]
        node = (key, parent, conv_id, depth, n_convs, children, leaves if children else 1, saved)
        if is_top:
            yield from out.add((*node[:4], None, *node[4:], True))
        else:
            queue.push((1 - depth, parent, node))
    yield out.taken()


def _process(nodes: DataFrame, most: int) -> DataFrame:
    """``_forward`` over the shards in each partition of ``nodes``."""
    return (
        nodes.sortWithinPartitions(F.col("depth").desc(), "key")
        .select(
            *("key", "parent", "conv_id", "depth", "n_convs", "own_saved"),
            *("children", "leaves", "saved", "is_top"),
        )
        .mapInArrow(partial(_forward, most=most), _NODE_TYPE)
    )


def trie(paths: DataFrame, shard_prefixes: int = SHARD_PREFIXES, queue_messages: int = QUEUE_MESSAGES) -> DataFrame:
    """One row per node of the trie of ``paths``, which come from ``prefixes``.

    conv_id (the smallest member), depth, parent_conv_id (null for the textless root), n_convs
    (members), n_children, n_leaves (childless nodes in the subtree, itself included),
    saved_tokens (over the subtree, (members - 1) times the code points of a node's last text) and
    ends_sha256 (of the ascending ids, joined by commas, of conversations that end here).

    Turns are ordered by ``turn``, nulls first; equal ones by the hash of what they say, so that
    repeated rows and ties give the same trie in every run. Rows with a null ``conv_id`` name no
    conversation and must be filtered out. Conversations and heavy nodes of any number go through;
    ids that end at one node stream through one task. No conversations give no rows.
    """
    paths = stage(paths, "prefixes")
    longest = paths.filter("is_end").select("conv_id", F.col("depth").alias("size"))
    ends = (
        paths.filter("is_end")
        .select("key", "conv_id")
        .repartition("key")
        .sortWithinPartitions("key", "conv_id")
        .mapInArrow(_hash_ends, "key binary, ends_sha256 string")
    )
    # Prefixes at a conversation's depth d have size - d others below them.
    merged = paths.join(longest, "conv_id").groupBy("key").agg(
        F.min("parent").alias("parent"),
        F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.min("chars").alias("chars"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("size") - F.col("depth") + 1).alias("below"),
    )
    nodes = stage(merged, "trie-nodes")
    limit = max(shard_prefixes, paths.count() // MAX_SHARDS)
    is_heavy = F.col("below") > limit
    heavy = stage(nodes.filter(is_heavy), "heavy-nodes")
    heavy_keys = few(heavy.select(F.col("key").alias("heavy"), F.col("conv_id").alias("heavy_conv")))
    # Where each conversation leaves the heavy nodes.
    cuts = (
        paths.join(heavy_keys, F.col("parent") == F.col("heavy"))
        .join(few(heavy.select("key")), "key", "left_anti")
        .select("conv_id", F.col("key").alias("shard"))
    )
    zero = F.lit(0).cast("long")
    light = nodes.filter(~is_heavy).join(cuts, "conv_id", "left").select(
        *_own_columns(),
        *[zero.alias(name) for name in ("children", "leaves", "saved")],
        (F.col("shard").isNull() & F.col("parent").isNull() | F.col("key").eqNullSafe(F.col("shard"))).alias("is_top"),
        F.coalesce("shard", F.lit(b"")).alias("shard"),
    )
    below = stage(_process(light.repartition("shard"), queue_messages), "shard-totals")
    sent = below.filter("is_top").groupBy(F.col("parent").alias("key")).agg(
        F.count(F.lit(1)).alias("children"),
        F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved"),
    )
    top = heavy.join(sent, "key", "left").select(
        *_own_columns(),
        *[F.coalesce(name, zero).alias(name) for name in ("children", "leaves", "saved")],
        F.col("parent").isNull().alias("is_top"),
    )
    # One task, over the heavy nodes alone: a row for every shard's way to the root, streamed.
    above = _process(top.repartition(1), queue_messages)
    hung = below.join(
        heavy_keys, F.col("is_top") & (F.col("parent") == F.col("heavy")), "left"
    ).withColumn("parent_conv_id", F.coalesce("parent_conv_id", "heavy_conv"))
    whole = hung.select("key", "conv_id", "depth", "parent_conv_id", *_TOTALS).unionByName(
        above.select("key", "conv_id", "depth", "parent_conv_id", *_TOTALS)
    )
    made = stage(
        whole.join(ends, "key", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())))
        .drop("key"),
        "trie",
    )
    for used in (paths, nodes, heavy, below):
        discard(used)
    return made


def _own_columns() -> list:
    own = ((F.col("n_convs") - 1) * F.col("chars")).alias("own_saved")
    return ["key", "parent", "conv_id", "depth", "n_convs", own]
