"""Benchmark decontamination by template canonicalisation, in SQL functions only.

Texts and benchmark items are reduced to templates: a word with a digit becomes
``<num>``, a unit after a number ``<unit>``, a capitalised word inside a
sentence ``<name>``, all else is lower case.  Every window of eight template
words (a shorter item: all its words) is hashed, and windows of items are
joined with windows of texts.  Windows that match along one alignment must also
agree on their slots: what stands in a placeholder of the item has to be
replaced by one and the same value throughout, and different values by
different ones.  So verbatim copies match and questions with other numbers,
names and units do, but chance meetings of templates do not.

Windows with fewer than ``PLAIN`` plain words match verbatim only: beside the
templates, the own words of windows with placeholders are hashed, and what
meets by them counts whether or not the slots of its neighbours agree.

Punctuation around words is left out of windows; it only tells where sentences
end.  A passage of ``LITERAL`` words in a row that agree verbatim counts whatever
share of the item it is.

Otherwise an item is in a text when consistent windows cover ``SHARE`` of it, or of its
windows with enough plain words, and at least ``LEAST`` windows (all, if it has
fewer).  White space of any kind and length counts as one space.  Null and empty texts match nothing;
items without words are ignored; long texts are read whole; repeated rows give
one pair per (text id, item id); rows with a null id are ignored; empty tables
give an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import settle

WINDOW = 8
SHARE, LEAST = 0.3, 3
#: So many words of an item in a row, word for word, are a quotation of it.
LITERAL = 13
#: Plain words of a window that matches with other slots, so that placeholders alone never do.
PLAIN = 4
#: Item windows that are broadcast at most (24 bytes each and their slots); more are joined by shuffle.
BROADCAST_WINDOWS = 200_000
#: Units, lower case.
UNITS = (
    "mm cm m km in ft yd mi inches feet yards miles meters metres kilometers mg g kg lb lbs oz grams kilograms pounds "
    "ounces ml l liters litres gallons s sec seconds min minutes h hours days weeks months years % percent degrees "
    "dollars euros cents usd eur"
).split()

#: Letters of Latin alphabets.
_CAPITAL, _SMALL = "A-ZÀ-ÖØ-Þ", "a-zß-öø-ÿ"
#: Punctuation around a word; % may be a unit.
_OUTER = r"(?<![\p{P}&&[^%]])[\p{P}&&[^%]]++(?!\S)|(?<!\S)[\p{P}&&[^%]]++"
_SPACE = r"[\x20\x09-\x0D]+"


def _words(text: Column) -> Column:
    return F.split(F.btrim(text, F.lit(" \t\n\v\f\r")), _SPACE)


def _bare(text: Column) -> Column:
    """Without punctuation around words; words of nothing else vanish."""
    return F.regexp_replace(text, _OUTER, "")


def _with_template(frame: DataFrame, text_col: str) -> DataFrame:
    """Adds ``_low``, the text with typed placeholders; words keep their places.

    Each step is a column of its own, so that none is computed twice.
    """
    units = "|".join(u.replace("%", "[%]") for u in UNITS)
    named, numbered = F.col("_named"), F.col("_numbered")
    return (
        # a capitalised word after a word that does not end a sentence
        frame.withColumn(
            "_named", F.regexp_replace(text_col, rf"[{_CAPITAL}](?<=[^\s.!?:\"] [{_CAPITAL}])[{_SMALL}]\S*+", "<name>")
        )
        .withColumn(
            "_numbered",
            F.lower(
                F.when(
                    named.rlike("[0-9]"), F.regexp_replace(named, r"(?<!\S)[^\s0-9]*+[0-9]\S*+", "<num>")
                ).otherwise(named)
            ),
        )
        .withColumn(
            "_low",
            F.when(
                numbered.contains("<num>"),
                F.regexp_replace(
                    numbered, rf"(?<=<num> )(?:{units})(?=[.,;:!?]?(?:\s|$))[.,;:!?]?", "<unit>"
                ),
            ).otherwise(numbered),
        )
    )


def _is_slot(word: Column) -> Column:
    return word.isin("<num>", "<unit>", "<name>")


def _own(text: Column) -> Column:
    """Lower case; words in capitals are marked, as they are no names in templates either."""
    marked = F.regexp_replace(text, rf"(?<!\S)(?=\S*?[{_CAPITAL}]{{2}})[^\s0-9{_SMALL}]++(?!\S)", "\u0001$0")
    return F.lower(F.when(text.rlike(f"[{_CAPITAL}]{{2}}"), marked).otherwise(text))


def _one_spaced(text: Column) -> Column:
    """White space of any kind and length as one space."""
    return F.when(text.rlike(r"[\x09-\x0D]|\x20\x20"), F.regexp_replace(text, _SPACE, " ")).otherwise(text)


def _prepared(rows: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """Id and template words of each text with words; its own words where there are placeholders.

    Nothing is filtered by a computed column: Spark would compute it again
    below every step that it is made of.  A text of punctuation only has one
    word, the empty one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    frame = rows.where(F.col(id_col).isNotNull() & text.rlike(r"[^\x20\x09-\x0D]")).select(
        F.col(id_col).alias(name), _one_spaced(text).alias("_text")
    )
    marked = F.col("_low").contains("<num>") | F.col("_low").contains("<name>")
    own = F.when(marked, _words(_own(_bare(F.col("_text")))))
    return (
        _with_template(frame, "_text")
        .select(name, _words(_bare(F.col("_low"))).alias("words"), own.alias("own"))
    )


Test = Callable[[Column], Column]
#: Bits of the table per hash, and the bits that a hash sets.
_BITS, _PROBES = 64, 3


@dataclass
class BitTable:
    """A test that is true for some hashes and for one in ten thousand others.

    The table is a literal in the plan, 8 bytes for each hash: up to 20
    characters a word in every text that Spark's driver makes of the plan.
    """

    table: Column
    mask: int

    def __call__(self, h: Column) -> Column:
        return self.within(lambda test: test(h))

    def within(self, make: Callable[[Test], Column]) -> Column:
        """What ``make`` makes of the test; the literal stands there once, however often the test is used."""
        return F.get(F.transform(F.array(self.table), lambda table: make(lambda h: self._holds(table, h))), F.lit(0))

    def _holds(self, table: Column, h: Column) -> Column:
        hits = []
        for i in range(_PROBES):
            at = F.shiftrightunsigned(h, 21 * i).bitwiseAND(F.lit(self.mask))
            hits.append(F.getbit(F.get(table, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return reduce(lambda x, y: x & y, hits)


def _table_of(hashes: list[int]) -> BitTable:
    m = max((_BITS * len(hashes)).bit_length(), 12)
    words, mask = [0] * (1 << (m - 6)), (1 << min(m, 21)) - 1

    def places(h: int) -> list[int]:
        return [(h >> (21 * i)) & mask for i in range(_PROBES)]

    for h in hashes:
        for at in places(h & ((1 << 64) - 1)):
            words[at >> 6] |= 1 << (at & 63)
    signed = [w - (1 << 64) if w >> 63 else w for w in words]
    return BitTable(F.from_json(F.lit(str(signed)), "array<bigint>"), mask)


@dataclass
class Seen:
    """Tests for the hashes of items' windows and of their first halves."""

    window: BitTable
    half: BitTable | None


def _with_windows(
    frame: DataFrame, length: int, words: str = "words", name: str = "_windows", seen: Seen | None = None
) -> DataFrame:
    """Adds ``_windows``, a hash for each window of ``length`` words (null without words).

    Hashes of 1, 2, 4, ... words are put together by halves, each a column of
    its own, so a window costs few steps whatever its length.  With ``seen`` a
    text in which no item's window begins has no windows.
    """
    frame = frame.withColumn("_h1", F.transform(words, lambda w: F.xxhash64(w)))
    have = 1

    def joined(first: Column, second: Column, by: int) -> Column:
        later = F.slice(second, by + 1, F.greatest(F.size(second), F.lit(1)))
        return F.zip_with(first, later, lambda a, b: F.xxhash64(a, b))

    def halved(column: str, longer: Column) -> Column:
        if seen is None or seen.half is None:
            return longer
        none = F.slice(F.array(F.lit(0).cast("bigint")), 1, 0)
        begins = seen.half.within(lambda test: F.exists(column, test))
        return F.when(F.col(words).isNotNull(), F.when(begins, longer).otherwise(none))

    while 2 * have <= length:
        longer = joined(F.col(f"_h{have}"), F.col(f"_h{have}"), have)
        if 2 * have == length:
            frame = frame.withColumn(f"{name}_half", F.col(f"_h{have}"))
            longer = halved(f"_h{have}", longer)
        frame = frame.withColumn(f"_h{2 * have}", longer)
        have *= 2
    windows, reached, part = F.col(f"_h{have}"), have, have // 2
    while part:
        if length & part:
            windows, reached = joined(windows, F.col(f"_h{part}"), reached), reached + part
        part //= 2
    # near the end the second half is missing: there is no window
    return frame.withColumn(name, F.slice(windows, 1, F.greatest(F.size(words) - (length - 1), F.lit(0))))


def _window_rows(prepared: DataFrame, name: str, length: int, seen: Seen | None = None) -> DataFrame:
    """One row per window: place, hash, and the words that stand there if some are replaced.

    Windows with placeholders have a second row, ``own``, with the hash of their own words.
    With ``seen`` only windows that may be an item's are given.
    The outer explode infers no filter on the windows, which would be pushed
    down and compute them again.
    """
    halves = length > 1 and length & (length - 1) == 0

    def at_places(windows: str, test: Test | None) -> Column:
        half = (lambda i: F.get(f"{windows}_half", i)) if halves and seen is None else lambda i: F.lit(None).cast("bigint")
        rows = F.transform(windows, lambda h, i: F.struct(h.alias("hash"), i.alias("at"), half(i).alias("half")))
        return rows if test is None else F.filter(rows, lambda w: test(w["hash"]))

    def row(w: Column, own: Column, plainly: bool) -> Column:
        return F.struct(w["hash"], w["at"], w["half"], own.alias("own"), F.lit(plainly).alias("plainly"))

    no_words = F.lit(None).cast("array<string>")

    def both(test: Test | None = None) -> Column:
        placed = F.transform(at_places("_windows", test), lambda w: row(w, F.slice("own", w["at"] + 1, F.lit(length)), False))
        plainly = F.transform(
            F.filter(at_places("_own_windows", test), lambda w: ~w["hash"].eqNullSafe(F.get("_windows", w["at"]))),
            lambda w: row(w, no_words, True),
        )
        return F.when(F.col("own").isNull(), placed).otherwise(F.concat(placed, plainly))

    rows = _with_windows(_with_windows(prepared, length, seen=seen), length, "own", "_own_windows", seen)
    rows = rows.withColumn("_rows", both() if seen is None else seen.window.within(both))
    return rows.select(name, F.explode_outer("_rows").alias("w")).select(
        name, F.col("w.at").alias(f"{name}_at"), "w.hash", F.col("w.half").alias(f"{name}_half"),
        F.col("w.own").alias(f"{name}_own"), F.col("w.plainly").alias(f"{name}_plainly"), F.lit(length).alias("length"),
    )


def _seen(of_items: DataFrame) -> dict[int, Seen]:
    """Tables of the hashes of items' windows, by their length; at most BROADCAST_WINDOWS."""
    found: dict[int, tuple[set, set]] = {}
    for length, window, half in of_items.select("length", "hash", "item_half").distinct().collect():
        windows, halves = found.setdefault(length, (set(), set()))
        windows.add(window)
        halves.add(half)
    return {
        n: Seen(_table_of(sorted(windows)), None if None in halves else _table_of(sorted(halves)))
        for n, (windows, halves) in found.items()
    }


def contaminated_pairs(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
) -> DataFrame:
    """One row per text and item found in it: ids, ``n_matched``, ``n_windows``, ``verbatim``."""
    prepared = settle(
        _prepared(items, item_id_col, item_text_col, "item").withColumn("n_words", F.size("words")).distinct(), "items"
    ).where(F.get("words", F.lit(0)) != "")
    short = prepared.where(F.col("n_words") < window).select("n_words").distinct().limit(window)
    lengths = [window, *sorted(r["n_words"] for r in short.collect())]
    of_items = reduce(
        DataFrame.unionAll,
        [
            _window_rows(
                prepared.where(F.col("n_words") == n if n < window else F.col("n_words") >= window), "item", n
            )
            for n in lengths
        ],
    ).where("hash is not null")
    kinds = F.slice("words", F.col("item_at") + 1, F.col("length"))
    of_items = of_items.join(prepared.select("item", "words"), "item").withColumn("kinds", kinds).drop("words")
    plain = F.size(F.filter("kinds", lambda w: ~_is_slot(w)))
    exact = F.col("item_plainly") | (plain == F.col("length"))
    of_items = of_items.withColumn("rich", plain >= F.least(F.lit(PLAIN), F.col("length"))).withColumn("exact", exact)
    of_items = settle(of_items.where("rich or exact").drop("item_plainly"), "item_windows")
    rich_at = F.when(F.col("rich"), F.col("item_at"))
    sizes = of_items.groupBy("item").agg(
        F.countDistinct("item_at").alias("n_windows"), F.countDistinct(rich_at).alias("n_rich")
    )
    small = of_items.count() <= BROADCAST_WINDOWS
    seen = _seen(of_items) if small else {}
    of_items = of_items.drop("item_half")
    side = F.broadcast(of_items) if small else of_items
    texts = _prepared(docs, id_col, text_col, "doc")
    met = (
        reduce(DataFrame.unionAll, [_window_rows(texts, "doc", n, seen.get(n)) for n in lengths])
        .join(side, ["hash", "length"])
        .withColumn("shift", F.col("doc_at") - F.col("item_at"))
    )
    # what stands in each placeholder of the item, and in the text
    pairs = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("length") - 1), lambda k: _is_slot(F.get("kinds", k))),
        lambda k: F.struct(F.get("item_own", k).alias("a"), F.get("doc_own", k).alias("b")),
    )
    pairs = F.when(~F.col("exact"), pairs)
    place = F.struct("item_at", "rich")
    # along one alignment an item has each window once, so these groups are as small as the item
    aligned = (
        met.select("doc", "item", "shift", "exact", place.alias("place"), pairs.alias("pairs"))
        .groupBy("doc", "item", "shift")
        .agg(
            F.collect_set("place").alias("places"),
            F.collect_set(F.when(F.col("exact"), F.col("place"))).alias("exact_places"),
            F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
        )
    )
    n = F.size("pairs")
    consistent = (F.size(F.array_distinct(F.col("pairs.a"))) == n) & (F.size(F.array_distinct(F.col("pairs.b"))) == n)

    def quoted(at: Column, i: Column) -> Column:
        """Whether enough windows in a row begin here."""
        more = LITERAL - window
        return F.coalesce(F.get("exact_at", i + more) - at == more, F.lit(False))

    found = (
        aligned.withColumn("consistent", consistent)
        .withColumn("same", ~F.col("consistent") | F.forall("pairs", lambda p: p["a"] == p["b"]))
        .withColumn("exact_at", F.array_sort(F.col("exact_places.item_at")))
        .withColumn("quoted", F.exists(F.transform("exact_at", quoted), lambda q: q))
        .withColumn("places", F.when(F.col("consistent"), F.col("places")).otherwise(F.col("exact_places")))
        .select("doc", "item", "same", "quoted", F.explode("places").alias("place"))
        .groupBy("doc", "item")
        .agg(
            F.countDistinct("place.item_at").alias("n_matched"),
            F.countDistinct(F.when(F.col("place.rich"), F.col("place.item_at"))).alias("n_rich_matched"),
            F.max("same").alias("verbatim"),
            F.max("quoted").alias("quoted"),
        )
    )

    def enough(matched: str, windows: str) -> Column:
        n = F.col(windows)
        return (n > 0) & (F.col(matched) >= F.least(n, F.greatest(F.lit(LEAST), F.ceil(n * SHARE))))

    return (
        found.join(sizes, "item")
        .where(enough("n_matched", "n_windows") | enough("n_rich_matched", "n_rich") | F.col("quoted"))
        .select(F.col("doc").alias(id_col), F.col("item").alias(item_id_col), "n_matched", "n_windows", "verbatim")
    )
