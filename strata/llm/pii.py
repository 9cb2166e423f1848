"""Personal data: base patterns, and bootstrapped contexts that find unseen identifiers.

Base kinds, leftmost and non-overlapping per kind: ``email``, ``ip`` (parts up
to 255), ``card`` (13 to 19 digits with a valid check digit) and ``phone`` (9
to 15 digits).  Base entities are the seeds: the words before and after them
induce lexical patterns.  Patterns and the values that fill them form a graph;
Spark scores it in rounds, a pattern by the share of its values that are
believed, a value by its best pattern.  Patterns of high confidence with many
different seeds then add spans of kind ``context``: values that look like
identifiers, stand in such a pattern and overlap no base span.

All of it is SQL functions.  Texts without a digit or an at sign are set aside
at once; matches are placed by the lengths of the pieces between them.  Null
and empty texts have no spans; long texts are searched whole; repeated rows
have equal spans; rows without an id keep their row; an empty table gives an
empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import settle

KINDS = ("email", "ip", "card", "phone", "context")
#: Fixed patterns of the base kinds.  Possessive quantifiers and the conditions on
#: the character before a match only spare the engine attempts that must fail.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "context": r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
#: Rounds of scoring, seeds a pattern needs, and the confidence that adds spans.
ROUNDS, SUPPORT, CONFIDENCE = 3, 20, 0.95
#: A value found by context has this many characters and digits at least, or an at sign.
VALUE_LENGTH, VALUE_DIGITS = 6, 4


def _check_digit(digits: Column) -> Column:
    """The sum of digits, every second one from the right doubled, is a multiple of ten."""
    turned = F.reverse(digits)

    def term(i: Column) -> Column:
        d = F.substring(turned, i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(
        F.transform(F.sequence(F.lit(0), F.length(digits) - 1), term), F.lit(0), lambda a, b: a + b
    )
    return total % 10 == 0


#: Characters before and after a match in which its neighbours are looked for.
REACH = 80


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _check_digit(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _matches(texts: DataFrame, kind: str) -> DataFrame:
    """Every match: ``uid``, ``kind``, ``value``, its span, the text before and after it."""
    pattern = PATTERNS[kind]
    sought = {"email": "[@]", "phone": "[+][0-9]", "ip": "[0-9][.][0-9]"}.get(kind, "[0-9@]")
    found = (
        texts.where(F.col("text").rlike(sought))
        .withColumn("hits", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
        .where(F.size("hits") > 0)
        .withColumn("gaps", F.split("text", pattern, -1))
        .select(
            "uid",
            F.posexplode(
                F.arrays_zip(
                    F.col("hits").alias("value"),
                    F.col("gaps").alias("before"),
                    F.slice("gaps", 2, F.size("hits")).alias("after"),
                )
            ).alias("i", "m"),
        )
        .where("m.value is not null")
    )
    so_far = Window.partitionBy("uid").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # only the words next to a match are carried on; one that does not end within reach is none
    blank = r"[\s]+"
    before, after = F.right("m.before", F.lit(REACH)), F.left("m.after", F.lit(REACH))
    before = F.when(F.length("m.before") > REACH, F.regexp_replace(before, r"^\S+", "")).otherwise(before)
    after = F.when(F.length("m.after") > REACH, F.regexp_replace(after, r"\S+$", "")).otherwise(after)
    return (
        found.select(
            "uid", "i", F.col("m.value").alias("value"), F.length("m.before").alias("gap"),
            F.substring_index(F.btrim(F.regexp_replace(before, blank, " ")), " ", -2).alias("left"),
            F.substring_index(F.btrim(F.regexp_replace(after, blank, " ")), " ", 1).alias("right"),
        )
        .withColumn("end", F.sum(F.col("gap") + F.length("value")).over(so_far).cast("int"))
        .select(
            "uid", F.lit(kind).alias("kind"), "value", (F.col("end") - F.length("value")).alias("start"), "end",
            F.lower("left").alias("left"), F.lower("right").alias("right"),
        )
    )


def _candidates(tokens: DataFrame, base: DataFrame) -> DataFrame:
    """Words that look like identifiers and touch no base span, without outer punctuation."""
    lead = F.length(F.regexp_extract("value", r"^[^A-Za-z0-9@+]*+", 0))
    tail = F.length(F.regexp_extract("value", r"[^A-Za-z0-9]*$", 0))
    size = F.length("value")
    core = F.substring(F.col("value"), F.col("lead") + 1, F.col("size") - F.col("lead") - F.col("tail"))
    looked = (
        tokens.withColumn("lead", lead)
        .withColumn("tail", tail)
        .withColumn("size", size)
        .where("lead + tail < size")
        .select(
            "uid", "kind", core.alias("value"), (F.col("start") + F.col("lead")).alias("start"),
            (F.col("end") - F.col("tail")).alias("end"), "left", "right",
        )
        .where(
            (F.length("value") >= VALUE_LENGTH)
            & (F.col("value").contains("@") | (F.length(F.regexp_replace("value", "[^0-9]", "")) >= VALUE_DIGITS))
        )
    )
    columns = ["uid", "kind", "value", "start", "end", "left", "right"]
    every = looked.select(*columns, F.lit(False).alias("base")).unionByName(
        base.select(*columns, F.lit(True).alias("base"))
    )
    up = Window.partitionBy("uid").orderBy("start", F.desc("base")).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("uid").orderBy(F.desc("start"), F.desc("base")).rowsBetween(Window.unboundedPreceding, -1)
    return (
        every.withColumn("reached", F.max(F.when(F.col("base"), F.col("end"))).over(up))
        .withColumn("next", F.min(F.when(F.col("base"), F.col("start"))).over(down))
        .where(~F.col("base"))
        .where(F.coalesce(F.col("reached") <= F.col("start"), F.lit(True)))
        .where(F.coalesce(F.col("next") >= F.col("end"), F.lit(True)))
        .select(*columns)
    )


def _with_patterns(rows: DataFrame) -> DataFrame:
    """One row per occurrence and pattern: the word before, two before, one on either side."""
    last = F.substring_index("left", " ", -1)
    patterns = F.array(
        F.concat(F.lit("1 "), last),
        F.when(F.col("left").contains(" "), F.concat(F.lit("2 "), "left")),
        F.when(F.length("right") > 0, F.concat(F.lit("3 "), last, F.lit(" _ "), "right")),
    )
    return rows.where(F.length("left") > 0).withColumn(
        "pattern", F.explode(F.filter(patterns, lambda p: p.isNotNull()))
    )


def score_graph(
    edges: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, least: float = 0.5
) -> tuple[DataFrame, DataFrame]:
    """Scores of patterns and of values from distinct ``edges`` (pattern, value, seed).

    A pattern's score is the sum of its values' scores over their number, if
    ``support`` different values at least are believed; a value's is the best
    score of its patterns, 1 for seeds.
    """
    values = edges.groupBy("value").agg(F.max(F.col("seed").cast("double")).alias("believed"))
    patterns = None
    for _ in range(rounds):
        patterns = settle(
            edges.join(values, "value")
            .groupBy("pattern")
            .agg(F.sum("believed").alias("sum"), F.count("*").alias("n"))
            .where((F.col("sum") >= support) & (F.col("sum") / F.col("n") >= least))
            .select("pattern", (F.col("sum") / F.col("n")).alias("score")),
            "patterns",
        )
        values = settle(
            edges.join(patterns, "pattern", "left")
            .groupBy("value")
            .agg(
                F.greatest(
                    F.max(F.col("seed").cast("double")), F.coalesce(F.max("score"), F.lit(0.0))
                ).alias("believed")
            ),
            "values",
        )
    return patterns, values


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and ``pii_spans``, by kind as listed, then start.

    Spans are ``struct<kind_no, start, end, kind>`` in characters, end exclusive.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    worth = F.coalesce(F.col("text").rlike("[0-9@]"), F.lit(False))
    texts = settle(rows.where(worth).withColumn("uid", F.monotonically_increasing_id()), "pii_texts")
    found = [_matches(texts, kind) for kind in KINDS[:4]]
    base = settle(
        reduce(DataFrame.unionByName, (m.where(_valid(k, F.col("value"))) for k, m in zip(KINDS, found, strict=False))),
        "pii_base",
    )
    other = settle(_candidates(_matches(texts, "context"), base), "pii_candidates")
    placed = settle(_with_patterns(other), "pii_contexts")
    edges = settle(
        _with_patterns(base)
        .select("pattern", "value", F.lit(True).alias("seed"))
        .unionByName(placed.select("pattern", "value", F.lit(False).alias("seed")))
        .groupBy("pattern", "value")
        .agg(F.max("seed").alias("seed")),
        "pii_edges",
    )
    patterns, values = score_graph(edges)
    added = (
        placed.join(patterns.where(F.col("score") >= CONFIDENCE), "pattern")
        .join(values.where(F.col("believed") >= CONFIDENCE), "value")
        .select("uid", "kind", "start", "end")
        .distinct()
    )
    number = F.create_map(*[F.lit(x) for k, name in enumerate(KINDS) for x in (name, k)])
    spans = (
        base.select("uid", "kind", "start", "end")
        .unionByName(added)
        .groupBy("uid")
        .agg(F.array_sort(F.collect_list(F.struct(number[F.col("kind")].alias("kind_no"), "start", "end", "kind"))).alias("s"))
    )
    none = F.array().cast("array<struct<kind_no:int,start:int,end:int,kind:string>>")
    return (
        texts.select("uid", "id")
        .join(spans, "uid", "left")
        .select("id", F.coalesce("s", none).alias("pii_spans"))
        .unionByName(rows.where(~worth).select("id", none.alias("pii_spans")))
        .withColumnRenamed("id", id_col)
    )
