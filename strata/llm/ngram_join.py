"""N-gram Jaccard join: tiles of similar size, bitmap bounds, exact intersections.

A text's set holds its distinct n-word shingles (the whole sequence if there
are fewer words).  Two texts link when intersection / union reaches the
threshold.  Every link is found:

* Equal sets are one set from the start, so copies cost nothing.
* Shingles are ordered, those that repeat most last; two linked sets share one
  among the first ``n - ceil(t n) + 1`` of each.  A shingle's sets form a tile,
  cut into bands of sizes that can link at all.
* First every set of a tile is compared with one of them only.  What these
  comparisons link falls into components; then pairs of one tile that still lie
  in different components are compared.  Tiles of frequent shingles hang
  together in clusters; there, sets outside the cluster's largest component are
  compared with all sets of similar size, block by block, and a block emits no
  more links than join its components.
* A comparison first bounds the overlap from above by hashed bitmaps (bits that
  only one side has are shingles that only one side has), then intersects the
  sorted arrays.

Texts without words have the empty set and link with nothing; null texts count
as empty; rows with a null id have no component and link with nothing; repeated
rows share a component; long texts are read whole; an empty table gives an
empty table.  Sets are known by 64-bit hashes, so two different ones would be
taken for equal once in about 10^19 pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.components import connected_components
from strata.llm.groups import group_starts, whole_groups
from strata.llm.words import Texts, bounded_batches, mix, parts, words_of
from strata.session import settle

SHINGLE = 4
PERCENT = 85
#: What ``keep_one`` takes for near copies, unless told otherwise.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80
#: Shingles that go last in the order: at most this many, each in this many sets or more.
HOT_KEPT, HOT_SETS = 65_536, 24
#: A tile of a hot shingle is dealt out to this many groups (numbered from 1, others have 0).
SALTS = 64
#: Sets of a block in a cluster of sets that share frequent shingles.
BLOCK_SETS = 384
#: Bits of the filter that says which texts' sets are needed again.
FILTER_BITS = 1 << 23
_WINDOW = 2_000_000


def _sets(texts: Texts, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = words_of(texts)
    n = len(words.hash)
    whole = np.zeros(max(n - k + 1, 0), np.uint64)
    for i in range(k):
        whole = whole * np.uint64(0xD6E8FEB86659FD93) + words.hash[i : i + len(whole)]
    whole = mix(whole)
    out = []
    for first, last in zip(words.first[:-1], words.first[1:], strict=True):
        if last - first >= k:
            out.append(np.unique(whole[first : last - k + 1]))
        elif last > first:
            short = words.hash[first:last].tobytes()
            out.append(np.array([xxhash.xxh3_64_intdigest(short, seed=int(last - first))], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _key(items: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(items.tobytes()) - (1 << 63)


def _bits(items: np.ndarray) -> bytes:
    """A bitmap of at least two bits per shingle, 256 to 65,536 in all."""
    width = min(max(256, 1 << int(2 * len(items) - 1).bit_length()), 65_536)
    bits = np.zeros(width, bool)
    bits[(items & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def overlap_bound(x: bytes, y: bytes, n_x: int, n_y: int) -> int:
    """No more shingles than this are in both sets."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] | a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] | b[len(b) // 2 :]
    only_x = int(np.bitwise_count(a & ~b).sum())
    only_y = int(np.bitwise_count(b & ~a).sum())
    return min(n_x - only_x, n_y - only_y)


def _linked(both: np.ndarray | int, n_x: np.ndarray | int, n_y: np.ndarray | int, percent: int):
    return 100 * both >= percent * (n_x + n_y - both)


def _summaries(k: int):
    """Per text its id, set size and set key; and shingles that repeat within the task."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        window: list[np.ndarray] = []
        held = 0

        def repeated() -> pa.RecordBatch:
            item, n = np.unique(np.concatenate(window), return_counts=True)
            item, n = item[n >= 4], n[n >= 4]
            return _rows([None] * len(item), np.full(len(item), -1), item.view(np.int64), n)

        for batch in batches:
            ids, done = batch.column(0), 0
            for texts in parts(batch.column(1)):
                sets = _sets(texts, k)
                keys = [_key(s) for s in sets]
                yield _rows(
                    ids.slice(done, texts.rows), np.array([len(s) for s in sets]), np.array(keys, np.int64),
                    np.zeros(len(sets)),
                )
                done += texts.rows
                for key, items in zip(keys, sets, strict=True):
                    if key not in seen:
                        seen.add(key)
                        window.append(items)
                        held += len(items)
                if held >= _WINDOW:
                    yield repeated()
                    window, held, seen = [], 0, set()
        if window:
            yield repeated()

    return summarise


def _rows(ids, size: np.ndarray, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()) if isinstance(ids, list) else ids.cast(pa.int64()),
            pa.array(size.astype(np.int64)),
            pa.array(key),
            pa.array(n.astype(np.int64)),
        ],
        names=["id", "size", "key", "n"],
    )


def _prefixes(k: int, percent: int, hot: np.ndarray):
    """The shingles by which a set meets others: hot ones last, else by hash."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for texts in parts(batch.column(0)):
                shingle, salt, key, size = [], [], [], []
                for items in _sets(texts, k):
                    n = len(items)
                    own = _key(items)
                    if not n or own in seen:
                        continue
                    seen.add(own)
                    take = n - -(-percent * n // 100) + 1
                    often = np.zeros(n, bool)
                    if len(hot):
                        at = np.minimum(np.searchsorted(hot, items), len(hot) - 1)
                        often = hot[at] == items
                    order = np.argsort(often, kind="stable")[:take]
                    shingle.append(items[order])
                    salt.append(np.where(often[order], own % SALTS + 1, 0))
                    key.append(np.full(len(order), own))
                    size.append(np.full(len(order), n))
                if len(seen) > 1_000_000:
                    seen = set()
                if shingle:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(shingle).view(np.int64)),
                            pa.array(np.concatenate(salt).astype(np.int32)),
                            pa.array(np.concatenate(key)),
                            pa.array(np.concatenate(size).astype(np.int32)),
                        ],
                        names=["shingle", "salt", "key", "size"],
                    )

    return emit


def _needed_sets(k: int, wanted: np.ndarray, column: str):
    """Sorted arrays or bitmaps of the texts that the filter lets pass."""
    mask = np.uint64(FILTER_BITS - 1)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in batches:
            place = (batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64) & mask).astype(np.int64)
            needed = (wanted[place >> 3] >> (place & 7)) & 1 == 1
            batch = batch.filter(pa.array(needed))
            done = 0
            for texts in parts(batch.column(2)):
                ids = batch.column(0).slice(done, texts.rows).to_pylist()
                done += texts.rows
                rows = {}
                for i, items in zip(ids, _sets(texts, k), strict=True):
                    if (i, key := _key(items)) not in known:
                        known.add((i, key))
                        rows[i, key] = items
                sets = list(rows.values())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i for i, _ in rows], pa.int64()),
                        pa.array([key for _, key in rows], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_bits(s) for s in sets], pa.binary())
                        if column == "bits"
                        else pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["id", "key", "size", column],
                )

    return emit


def _passes(wanted: np.ndarray) -> Column:
    @F.arrow_udf(T.BooleanType())
    def passes(column: pa.Array) -> pa.Array:
        place = (column.to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64(FILTER_BITS - 1)).astype(np.int64)
        return pa.array((wanted[place >> 3] >> (place & 7)) & 1 == 1)

    return passes


def _may_link(percent: int) -> Column:
    @F.arrow_udf(T.BooleanType())
    def bound(x: pa.Array, y: pa.Array, n_x: pa.Array, n_y: pa.Array) -> pa.Array:
        rows = zip(x.to_pylist(), y.to_pylist(), n_x.to_pylist(), n_y.to_pylist(), strict=True)
        return pa.array([bool(_linked(overlap_bound(*row), row[2], row[3], percent)) for row in rows], pa.bool_())

    return bound


def _do_link(percent: int) -> Column:
    @F.arrow_udf(T.BooleanType())
    def exact(x: pa.Array, y: pa.Array) -> pa.Array:
        out = []
        for i in range(len(x)):
            a, b = x[i].values.to_numpy(), y[i].values.to_numpy()
            both = len(a) + len(b) - len(np.union1d(a, b))
            out.append(bool(_linked(both, len(a), len(b), percent)))
        return pa.array(out, pa.bool_())

    return exact


def _filter_of(ids: DataFrame) -> np.ndarray:
    """A bit per hash of a wanted id: ``FILTER_BITS`` bits at any size of input."""
    places = ids.select(F.xxhash64("id").bitwiseAND(FILTER_BITS - 1).alias("place"))
    found = (
        places.groupBy(F.shiftright("place", 3).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1, cast(place & 7 as int))")).alias("bits"))
        .toArrow()
    )
    table = np.zeros(FILTER_BITS // 8, np.uint8)
    table[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return table


def _side(sets: DataFrame, name: str, *columns: str) -> DataFrame:
    return sets.select(F.col("key").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in columns))


def _likely(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bitmaps leave room for enough overlap."""
    return settle(
        pairs.join(_side(bitmaps, "b", "size", "bits"), "b")
        .join(_side(bitmaps, "a", "size", "bits"), "a")
        .where(_may_link(percent)("bits_a", "bits_b", "size_a", "size_b"))
        .select("a", "b"),
        "likely",
    )


def _links(likely: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sorted arrays overlap enough."""
    return settle(
        likely.join(_side(arrays, "b", "items"), "b")
        .join(_side(arrays, "a", "items"), "a")
        .where(_do_link(percent)("items_a", "items_b"))
        .select("a", "b"),
        "linked",
    )


def _sizes_fit(x: str, y: str, percent: int) -> Column:
    return (F.col(x) * 100 >= F.col(y) * percent) & (F.col(y) * 100 >= F.col(x) * percent)


def ngram_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """Per row: id, ``n_shingles`` and ``component_id``, the smallest id that links reach."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = settle(texts.mapInArrow(_summaries(shingle), "id long, size long, key long, n long"), "sets")
    rows = found.where("size >= 0").select("id", "size", "key")
    hot = (
        found.where("size < 0")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= HOT_SETS)
        .orderBy(F.desc("n"), "key")
        .limit(HOT_KEPT)
        .toArrow()
    )
    order = np.sort(hot.column("key").to_numpy().view(np.uint64))

    tiles = _tiles(texts, shingle, percent, order)
    chosen = settle(
        rows.where("id is not null")
        .join(tiles.select("key").distinct(), "key")
        .groupBy("key")
        .agg(F.min("id").alias("id")),
        "chosen",
    )
    bitmaps = settle(_sets_of(texts, chosen, shingle, "bits"), "bitmaps")

    def verified(pairs: DataFrame) -> DataFrame:
        likely = _likely(pairs, bitmaps, percent)
        keys = likely.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        arrays = settle(_sets_of(texts, settle(chosen.join(keys, "key"), "chosen"), shingle, "items"), "arrays")
        return _links(likely, arrays, percent)

    first = settle(_first_pairs(tiles, percent), "pairs")
    links = verified(first)
    joined = connected_components(links)
    more = _cross_pairs(tiles.where("salt = 0"), joined, percent).join(first, ["a", "b"], "left_anti")
    links = links.unionByName(verified(settle(more, "pairs")))
    member = _cluster_members(tiles.where("salt > 0"), joined, percent)
    arrays = _sets_of(texts, settle(chosen.join(member.select("key"), "key"), "chosen"), shingle, "items")
    links = links.unionByName(_cluster_links(member, arrays, percent))
    component = connected_components(links).withColumnRenamed("id", "key")

    # one row per set from here on, however many texts have it; stored sides let Spark split a hot key or label
    sets = settle(rows.groupBy("key").agg(F.min("id").alias("first"), F.max("size").alias("size")), "distinct-sets")
    labelled = settle(
        sets.where("size > 0").join(component, "key", "left").withColumn("label", F.coalesce("component", "key")), "labels"
    )
    least = settle(labelled.groupBy("label").agg(F.min("first").alias("least")), "least")
    of_set = settle(labelled.select("key", "label").join(least, "label").select("key", "least"), "set-components")
    return rows.join(of_set, "key", "left").select(
        F.col("id").alias(id_col),
        F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.when(F.col("id").isNotNull(), F.col("least"))).otherwise(F.col("id")).alias(
            "component_id"
        ),
        F.col("key").alias("set_key"),
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = NEAR_SHINGLE,
    percent: int = NEAR_PERCENT,
) -> DataFrame:
    """The row with the smallest id of each component, all columns.

    Of repeated rows one stays; rows that share an id and differ in their texts
    are decided each by its own text; rows with a null id all stay.
    """
    found = settle(ngram_components(docs, id_col, text_col, shingle, percent), "components")
    ids = found.where(F.col(id_col).isNotNull()).groupBy(id_col).count()
    twice = settle(ids.where("count > 1").select(id_col), "repeated-ids")
    gone = found.where(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    # a filter of fixed size lets most rows stay where they are; the join decides on the rest
    asked = gone.unionByName(twice)
    listed = _passes(_filter_of(asked.select(F.col(id_col).cast("long").alias("id"))))(F.xxhash64(F.col(id_col).cast("long")))
    rest = docs.where(listed).join(asked, id_col, "left_anti").select(*docs.columns)
    kept = docs.where(~listed).unionByName(rest)
    if twice.isEmpty():
        return kept
    left = found.where(F.col(id_col) == F.col("component_id")).select(id_col, "set_key").distinct()
    keyed = docs.join(twice, id_col, "left_semi").withColumn("set_key", _set_key(shingle)(F.col(text_col)))
    decided = keyed.join(left, [id_col, "set_key"], "left_semi").dropDuplicates([id_col, "set_key"])
    return kept.unionByName(decided.select(*docs.columns))


def _set_key(shingle: int):
    """A column function: the key of a text's set."""

    @F.arrow_udf(T.LongType())
    def key(column: pa.Array) -> pa.Array:
        return pa.array([_key(s) for texts in parts(column) for s in _sets(texts, shingle)], pa.int64())

    return key


def _tiles(texts: DataFrame, shingle: int, percent: int, hot: np.ndarray) -> DataFrame:
    """Sets by prefix shingle, with each tile's smallest set; lone sets are left out."""
    members = (
        texts.where("id is not null")
        .select("text")
        .mapInArrow(_prefixes(shingle, percent, hot), "shingle long, salt int, key long, size int")
        .repartition("shingle", "salt")
        .dropDuplicates(["shingle", "salt", "key"])
    )
    group = "partition by shingle, salt"
    return settle(
        members.select(
            "*",
            F.expr(f"count(*) over ({group})").alias("n"),
            F.expr(f"min(struct(key, size)) over ({group})").alias("pivot"),
        )
        .where("n > 1 or salt > 0")
        .drop("n"),
        "tiles",
    )


def _first_pairs(tiles: DataFrame, percent: int) -> DataFrame:
    """Each set with its tile's pivot, and the pivots of a dealt-out tile with one of them."""
    near = tiles.select("key", "size", F.col("pivot.key").alias("other"), F.col("pivot.size").alias("other_size"))
    heads = tiles.where("salt > 0").select("shingle", "pivot").distinct()
    top = heads.groupBy("shingle").agg(F.min("pivot").alias("top"))
    far = heads.join(top, "shingle").select(
        F.col("pivot.key").alias("key"), F.col("pivot.size").alias("size"),
        F.col("top.key").alias("other"), F.col("top.size").alias("other_size"),
    )
    return (
        near.unionByName(far)
        .where(F.col("key") != F.col("other"))
        .where(_sizes_fit("size", "other_size", percent))
        .select(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b"))
        .distinct()
    )


def _cross_pairs(tiles: DataFrame, component: DataFrame, percent: int) -> DataFrame:
    """Pairs of a tile that lie in different components.

    One side of each pair lies outside the tile's largest component, so a tile
    whose sets have all been linked emits nothing.
    """
    labelled = (
        tiles.select("shingle", "key", "size")
        .join(component.withColumnRenamed("id", "key"), "key", "left")
        .select("shingle", "key", "size", F.coalesce("component", "key").alias("label"))
    )
    labelled = settle(labelled, "labelled")
    largest = (
        labelled.groupBy("shingle", "label")
        .count()
        .groupBy("shingle")
        .agg(F.max(F.struct("count", "label")).alias("most"), F.count("*").alias("labels"))
        .where("labels > 1")
        .select("shingle", F.col("most.label").alias("largest"))
    )
    outside = labelled.join(largest, "shingle").where("label <> largest")
    other = labelled.select(
        "shingle", F.col("key").alias("key2"), F.col("size").alias("size2"), F.col("label").alias("label2")
    )
    return (
        outside.join(other, "shingle")
        .where("label <> label2 and (label2 = largest or key < key2)")
        .where(_sizes_fit("size", "size2", percent))
        .select(F.least("key", "key2").alias("a"), F.greatest("key", "key2").alias("b"))
        .distinct()
    )


def _cluster_members(hot: DataFrame, component: DataFrame, percent: int) -> DataFrame:
    """Sets of clusters that are not one component yet, with their blocks.

    A cluster is what shared frequent shingles connect.  ``minor`` marks sets
    outside its largest component; ``blocks`` has, for each band of sizes, how
    many blocks of all sets and of minor sets there are.
    """
    heads = hot.select("shingle", "pivot").distinct()
    top = heads.groupBy("shingle").agg(F.min("pivot").alias("top"))
    edges = hot.select(F.col("key").alias("a"), F.col("pivot.key").alias("b")).unionByName(
        heads.join(top, "shingle").select(F.col("pivot.key").alias("a"), F.col("top.key").alias("b"))
    )
    cluster = connected_components(edges).select(F.col("id").alias("key"), F.col("component").alias("cluster"))
    # bands so wide that sets that can link are at most one band apart
    band = F.floor(F.log(F.col("size").cast("double")) / (float(np.log(100 / percent)) + 1e-9)).cast("int")
    labelled = settle(
        hot.groupBy("key")
        .agg(F.first("size").alias("size"))
        .join(cluster, "key")
        .join(component.withColumnRenamed("id", "key"), "key", "left")
        .select("key", "cluster", F.coalesce("component", "key").alias("label"), band.alias("band")),
        "clusters",
    )
    largest = (
        labelled.groupBy("cluster", "label")
        .count()
        .groupBy("cluster")
        .agg(F.max(F.struct("count", "label")).alias("most"), F.count("*").alias("labels"))
        .where("labels > 1")
        .select("cluster", F.col("most.label").alias("largest"))
    )
    member = labelled.join(largest, "cluster").withColumn("minor", F.col("label") != F.col("largest"))
    count = F.ceil(F.count("*") / F.lit(BLOCK_SETS)).cast("int")
    minor = F.ceil(F.sum(F.col("minor").cast("int")) / F.lit(BLOCK_SETS)).cast("int")
    blocks = (
        member.groupBy("cluster", "band")
        .agg(F.struct(count.alias("all"), minor.alias("minor")).alias("n"))
        .groupBy("cluster")
        .agg(F.map_from_entries(F.collect_list(F.struct("band", "n"))).alias("blocks"))
    )
    return settle(
        member.join(blocks, "cluster").select("key", "cluster", "label", "band", "minor", "blocks"), "cluster_members"
    )


def _cluster_links(member: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """Links of minor sets to any sets of similar size in their cluster, one block against another."""

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        """Each set in a block of its band, once for each block it meets."""
        near = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))
        block = F.pmod(F.xxhash64("key"), F.col("blocks")[F.col("band")][own])
        met = F.explode(F.sequence(F.lit(0), F.col("blocks")[F.col("near")][other] - 1))
        at = rows.withColumn("block", block).withColumn("near", near)
        at = at.where(F.col("blocks")[F.col("near")][other] > 0).withColumn("met", met)
        mine = (F.col("band"), F.col("block"))
        theirs = (F.col("near"), F.col("met"))
        place = (*mine, *theirs) if own == "minor" else (*theirs, *mine)
        return at.select(
            F.xxhash64("cluster", *(c.cast("long") for c in place)).alias("tile"), F.lit(own == "minor").alias("minor"), "key", "label"
        )

    rows = dealt(member.where("minor"), "minor", "all").unionByName(dealt(member, "all", "minor"))
    return settle(
        rows.join(arrays.select("key", "items"), "key")
        .repartition("tile")
        .sortWithinPartitions("tile")
        .mapInArrow(_compare_blocks(percent), "a long, b long")
        .distinct(),
        "cluster_links",
    )


def _bit_rows(sets: list[np.ndarray], width: int) -> np.ndarray:
    bits = np.zeros((len(sets), width), bool)
    for row, items in zip(bits, sets, strict=True):
        row[(items & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, axis=1).view(np.uint64)


def _compare_blocks(percent: int):
    """Per tile: bitmap bounds of a minor set against all, then exact overlaps where they allow a link."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "tile"):
            starts = np.append(group_starts(table, ("tile",)), table.num_rows)
            keys, labels = table.column("key").to_numpy(), table.column("label").to_numpy()
            minor = table.column("minor").to_numpy(zero_copy_only=False)
            items = table.column("items").combine_chunks()
            found: list[tuple[int, int]] = []
            for first, last in zip(starts[:-1], starts[1:], strict=True):
                sets = [items[i].values.to_numpy().view(np.uint64) for i in range(first, last)]
                sets = [np.sort(x) for x in sets]
                size = np.array([len(x) for x in sets])
                width = min(max(256, 1 << int(2 * size.max() - 1).bit_length()), 65_536)
                bits = _bit_rows(sets, width)
                side = minor[first:last]
                some = np.flatnonzero(~side)
                label = labels[first:last].copy()
                for i in np.flatnonzero(side):
                    left = np.bitwise_count(bits[i] & ~bits[some]).sum(1)
                    right = np.bitwise_count(bits[some] & ~bits[i]).sum(1)
                    bound = np.minimum(size[i] - left.astype(np.int64), size[some] - right.astype(np.int64))
                    may = some[(label[some] != label[i]) & _linked(bound, size[i], size[some], percent)]
                    if not len(may):
                        continue
                    flat = np.concatenate([sets[j] for j in may])
                    at = np.minimum(np.searchsorted(sets[i], flat), size[i] - 1)
                    both = np.add.reduceat(sets[i][at] == flat, np.cumsum(size[may]) - size[may], dtype=np.int64)
                    for j in may[_linked(both, size[i], size[may], percent)]:
                        if label[j] != label[i]:
                            found.append((keys[first + i], keys[first + j]))
                            label[label == label[j]] = label[i]
            if found:
                a, b = np.array(found, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return compare


def _sets_of(texts: DataFrame, chosen: DataFrame, shingle: int, column: str) -> DataFrame:
    """Bitmaps or arrays of the chosen sets, from one text each.

    A filter of fixed size lets few other texts pass; the join is exact.
    """
    kind = {"bits": "binary", "items": "array<long>"}[column]
    found = texts.select("id", F.xxhash64("id").alias("place"), "text").where("id is not null")
    return (
        found.mapInArrow(
            _needed_sets(shingle, _filter_of(chosen), column), f"id long, key long, size long, {column} {kind}"
        )
        .join(chosen, ["id", "key"])
        .select("key", "size", column)
    )
