"""Prefix trie of conversations: shards of sorted paths under a broadcast skeleton.

A conversation's path is the row of digests of its turns.  Sorted by path and
id, the members of every trie node lie side by side.  Splitters cut that order
into shards; a node whose members lie in two shards is a prefix of a splitter.
Those nodes are the skeleton: a small trie of splitter paths, known before the
shards are read and broadcast to them.  A task streams through its shard once
with one open node per depth, finishes every other node by itself, and gives
partial aggregates of skeleton nodes, which are summed over the shards and
rolled up along the skeleton.

Splitters are cut behind the first turn that sets them apart from the sample
before them, or carry the whole path and an id where copies are so many that
they need several shards, so a group of equal conversations can be split.

Memory: texts become digests where they are read; a conversation is one row of
24 bytes a turn (its ends at Spark's row size, tens of millions of turns); a
task holds one path, the direct children of open nodes and one chunk of ids.
The sample, the splitters and the skeleton are bounded by the constants below,
whatever the table's size.  The ids that end at a skeleton node are moved as
chunks of text to the task that hashes them in order.

Null roles and texts count as empty; turns without a number come first, turns
with the same number in the order of their digests, so repeated rows are
repeated turns; rows without a conversation id are left out; an empty table has
no nodes; other columns are not read.  Equal MD5 digests count as equal turns.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import settle, struct

#: Bytes of a turn's digest in a path.
STEP = 16
SAMPLES_PER_SHARD = 20
MOST_SHARDS = 4_096
#: Bytes of all sampled paths together, and nodes of the skeleton, at most.
SAMPLE_BYTES = 32_000_000
MOST_SKELETON = 100_000
#: Ids in a chunk, rows in a batch of results.
CHUNK, BATCH = 8_192, 8_192
WORD = r"[^\x20\x09-\x0D]+"

NODE, PARTIAL, ENDS = 0, 1, 2
_LONG = T.LongType()
GROWN = struct(
    kind=T.IntegerType(), conv_id=_LONG, depth=_LONG, parent_conv_id=_LONG, skeleton=_LONG, n_convs=_LONG,
    n_children=_LONG, n_leaves=_LONG, saved_tokens=_LONG, words=_LONG, seq=_LONG, body=T.StringType(),
)
NODES = struct(
    conv_id=_LONG, depth=_LONG, parent_conv_id=_LONG, n_convs=_LONG, n_children=_LONG, n_leaves=_LONG,
    saved_tokens=_LONG, ends_sha256=T.StringType(),
)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def conversations_of(rows: DataFrame) -> DataFrame:
    """``conv_id`` and its ``turns`` in order: ``array<struct<turn, digest, words>>``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    words = F.regexp_count(text, F.lit(WORD)).cast("long")
    return (
        rows.select(
            F.col("conv_id").cast("long"),
            F.struct(F.col("turn").cast("long"), digest.alias("digest"), words.alias("words")).alias("t"),
        )
        .where(F.col("conv_id").isNotNull())
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
    )


def with_shared_heads(conversations: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Every conversation with its first turns taken from the first of its family.

    The first ``h`` turns (a checksum of the id modulo ``most``) come from the
    conversation ``conv_id - conv_id % family``, the rest are its own.
    """
    c = F.col("conv_id")
    heads = conversations.where(c % family == 0).select(
        c.alias("base"), F.slice("turns", 1, most - 1).alias("head")
    )
    h = (F.crc32(c.cast("string").cast("binary")) % most).cast("int")
    return (
        conversations.withColumn("base", c - c % family)
        .join(heads, "base", "left")
        .select(
            "conv_id",
            F.concat(
                F.coalesce(F.slice("head", F.lit(1), h), F.expr("slice(turns, 1, 0)")),
                F.slice("turns", h + 1, F.size("turns")),
            ).alias("turns"),
        )
    )


@dataclass
class Skeleton:
    """Splitters, and the trie of their paths; a parent's number is below its children's."""

    splitters: list[tuple] = field(default_factory=list)
    child: dict[tuple[int, bytes], int] = field(default_factory=dict)
    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common from the start."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size // STEP
    low, high = 0, size // STEP
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * STEP] == b[: middle * STEP]:
            low = middle
        else:
            high = middle - 1
    return low


def skeleton_of(sample: list[tuple[bytes, int, bool]], shards: int, most: int = MOST_SKELETON) -> Skeleton:
    """Splitters at even steps of a sample of (path, id, path is whole), and their trie."""
    sample = sorted(sample)
    found = set()
    for i in range(1, shards):
        at = i * len(sample) // shards
        if at < 1:
            continue
        (before, _, _), (path, conv_id, whole) = sample[at - 1], sample[at]
        if path != before:
            found.add((path[: (common_turns(before, path) + 1) * STEP], float("-inf")))
        elif whole:
            found.add((path, conv_id))
    splitters = sorted(found)
    while True:
        made = Skeleton(splitters)
        for path, _ in splitters:
            node = 0
            for at in range(0, len(path), STEP):
                key = (node, path[at : at + STEP])
                if key not in made.child:
                    made.child[key] = len(made.parent)
                    made.parent.append(node)
                    made.depth.append(made.depth[node] + 1)
                node = made.child[key]
        if len(made.parent) <= most:
            return made
        splitters = splitters[1::2]


def _sampled(paths: DataFrame, total: int, shards: int) -> list[tuple[bytes, int, bool]]:
    wanted = SAMPLES_PER_SHARD * shards
    most = max(SAMPLE_BYTES // (2 * wanted) // STEP, 1) * STEP
    share = int(min(1.0, wanted / total) * 2**30)
    taken = paths.where(F.shiftrightunsigned(F.xxhash64("conv_id"), 34) < share).limit(2 * wanted)
    return [
        (bytes(r["head"]), r["conv_id"], r["size"] <= most)
        for r in taken.select(
            F.substring("path", 1, most).alias("head"), "conv_id", F.length("path").alias("size")
        ).collect()
    ]


class _Open:
    """A node on the current path: what its members have given so far."""

    __slots__ = ("chunks", "hash", "ids", "kids", "leaves", "least", "n", "pending", "saved", "skeleton", "words")

    def __init__(self, skeleton: int | None, words: int) -> None:
        self.skeleton, self.words = skeleton, words
        self.n = self.kids = self.leaves = self.saved = self.chunks = 0
        self.least: int | None = None
        self.ids: list[str] = []
        self.hash = None
        self.pending: list[tuple] = []


class _Shard:
    """One pass over a shard's sorted paths."""

    def __init__(self, skeleton: Skeleton, shard: int) -> None:
        self.skeleton, self.number = skeleton, shard
        self.stack = [_Open(0, 0)]
        self.path = b""
        self.rows: list[tuple] = []

    def add(self, path: bytes, conv_id: int, words: list[int]) -> None:
        shared = common_turns(self.path, path)
        while len(self.stack) > shared + 1:
            self._close()
        for d in range(shared, len(path) // STEP):
            above = self.stack[-1].skeleton
            known = None if above is None else self.skeleton.child.get((above, path[d * STEP : (d + 1) * STEP]))
            self.stack.append(_Open(known, words[d]))
        self.path = path
        top = self.stack[-1]
        top.n += 1
        top.least = conv_id if top.least is None else min(top.least, conv_id)
        top.ids.append(str(conv_id))
        if len(top.ids) >= CHUNK:
            self._flush_ids(top)

    def finish(self) -> None:
        while self.stack:
            self._close()

    def _flush_ids(self, node: _Open) -> None:
        if not node.ids:
            return
        text = ",".join(node.ids)
        if node.skeleton is not None:
            seq = self.number << 32 | node.chunks
            self.rows.append((ENDS, None, None, None, node.skeleton, None, None, None, None, None, seq, text))
        else:
            node.hash = node.hash or hashlib.sha256()
            node.hash.update((f",{text}" if node.chunks else text).encode())
        node.chunks += 1
        node.ids = []

    def _close(self) -> None:
        node = self.stack.pop()
        depth = len(self.stack)
        self._flush_ids(node)
        above = self.stack[-1] if self.stack else None
        if above is not None:
            above.n += node.n
            if node.least is not None:
                above.least = node.least if above.least is None else min(above.least, node.least)
        if node.skeleton is not None:
            if node.n:
                self.rows.append(
                    (PARTIAL, node.least, depth, None, node.skeleton, node.n, node.kids, node.leaves, node.saved,
                     node.words, None, None)
                )
            return
        leaves = node.leaves or 1
        saved = node.saved + (node.n - 1) * node.words
        for row in node.pending:
            self.rows.append((NODE, row[0], row[1], node.least, None, *row[2:6], None, None, row[6]))
        mine = (node.least, depth, node.n, node.kids, leaves, saved, node.hash.hexdigest() if node.hash else NO_ENDS)
        above.kids += 1
        above.leaves += leaves
        above.saved += saved
        if above.skeleton is None:
            above.pending.append(mine)
        else:
            self.rows.append((NODE, mine[0], depth, None, above.skeleton, *mine[2:6], None, None, mine[6]))


_ARROW = pa.schema(
    [(f.name, pa.string() if f.name == "body" else pa.int32() if f.name == "kind" else pa.int64()) for f in GROWN]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def _grown(batches: Iterator[pa.RecordBatch], skeleton: Skeleton) -> Iterator[pa.RecordBatch]:
    """Nodes, partial aggregates and chunks of ids of the shards in a task."""
    shard = None
    for batch in batches:
        for number, path, conv_id, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if shard is None or number != shard.number:
                if shard is not None:
                    shard.finish()
                    if shard.rows:
                        yield _batch(shard.rows)
                shard = _Shard(skeleton, number)
            shard.add(path, conv_id, words)
            if len(shard.rows) >= BATCH:
                yield _batch(shard.rows)
                shard.rows = []
    if shard is not None:
        shard.finish()
        if shard.rows:
            yield _batch(shard.rows)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each skeleton node's ids, from its chunks in order."""
    keys, digests, running = [], [], None
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not keys or key != keys[-1]:
                if running is not None:
                    digests.append(running.hexdigest())
                keys.append(key)
                running = hashlib.sha256(text.encode())
            else:
                running.update(f",{text}".encode())
    if running is not None:
        digests.append(running.hexdigest())
        yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(digests, pa.string())], names=["skeleton", "sha"])


def _reduced(spark: SparkSession, grown: DataFrame, skeleton: Skeleton, shards: int) -> DataFrame:
    """Whole rows of the skeleton's nodes: summed over shards, rolled up from below."""
    of = F.col("kind")
    sums = (
        grown.where(of == PARTIAL)
        .groupBy("skeleton")
        .agg(
            F.min("conv_id"), F.sum("n_convs"), F.sum("n_children"), F.sum("n_leaves"), F.sum("saved_tokens"),
            F.max("words"),
        )
    )
    chunks = grown.where(of == ENDS).select("skeleton", "body", "seq")
    ends = dict(
        chunks.repartition(shards, "skeleton")
        .sortWithinPartitions("skeleton", "seq")
        .select("skeleton", "body")
        .mapInArrow(_hashed, "skeleton long, sha string")
        .collect()
    )
    # at most MOST_SKELETON rows
    nodes = {r[0]: list(r[1:]) for r in sums.collect()}
    rows = []
    for k in sorted(nodes, reverse=True):  # children have higher numbers
        least, n, kids, leaves, saved, words = nodes[k]
        leaves = leaves if kids else 1
        saved += (n - 1) * words
        up = skeleton.parent[k]
        if up >= 0:
            nodes[up][2] += 1
            nodes[up][3] += leaves
            nodes[up][4] += saved
        parent = nodes[up][0] if up >= 0 else None
        rows.append((k, least, skeleton.depth[k], parent, n, kids, leaves, saved, ends.get(k, NO_ENDS)))
    return spark.createDataFrame(rows, T.StructType([T.StructField("skeleton", _LONG), *NODES]))


def prefix_trie(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """All nodes of the trie of ``conversations`` (``conv_id``, ``turns``), from the root on.

    Per node: its smallest member, depth, the parent's smallest member, members,
    children, leaves below or at it, the words that sharing its subtree's
    prefixes saves, and the SHA-256 of the ids of the members that end there.
    Ids must not repeat.
    """
    spark = conversations.sparkSession
    digests: Column = F.array_join(F.transform("turns", lambda t: t["digest"]), "")
    paths = settle(
        conversations.select(
            "conv_id", F.unhex(digests).alias("path"), F.transform("turns", lambda t: t["words"]).alias("words")
        ),
        "paths",
    )
    total = paths.count()
    if not total:
        return spark.createDataFrame([], NODES)
    shards = min(shards or int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_SHARDS)
    skeleton = skeleton_of(_sampled(paths, total, shards), shards)
    shared = spark.sparkContext.broadcast(skeleton)

    @F.arrow_udf(T.IntegerType())
    def shard_of(path: pa.Array, conv_id: pa.Array) -> pa.Array:
        pairs = zip(path.to_pylist(), conv_id.to_pylist(), strict=True)
        return pa.array([shared.value.shard(p, c) for p, c in pairs], pa.int32())

    grown = settle(
        paths.select(shard_of("path", "conv_id").alias("shard"), "path", "conv_id", "words")
        .repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("shard", "path", "conv_id")
        .mapInArrow(lambda batches: _grown(batches, shared.value), GROWN),
        "trie",
        ["kind"],
    )
    skeleton_rows = _reduced(spark, grown, skeleton, shards)
    columns = NODES.fieldNames()
    own = grown.where(F.col("kind") == NODE).withColumnRenamed("body", "ends_sha256")
    known = skeleton_rows.select("skeleton", F.col("conv_id").alias("above"))  # MOST_SKELETON rows at most
    return (
        own.join(F.broadcast(known), "skeleton", "left")
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
        .select(*columns)
        .unionByName(skeleton_rows.select(*columns))
    )
