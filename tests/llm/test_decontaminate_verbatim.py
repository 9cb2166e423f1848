import pytest

from strata.llm import decontaminate as D

SHORT = "Who painted the Mona Lisa?"
NAMES = "John Smith, Mary Jones, Peter Brown and Anna White met in Paris, France in May 1999"
NUMBERS = "12 13 14 15 16 17 18 19 20"


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, SHORT), (2, NAMES), (3, NUMBERS)]
    return spark.createDataFrame(rows, "item_id long, text string")


def found(spark, items, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = D.contaminated_pairs(docs, items).collect()
    return {(r["doc_id"], r["item_id"]): (r["n_matched"], r["n_windows"], r["verbatim"]) for r in rows}


def test_items_of_few_plain_words_are_found_as_copies_only(spark, items):
    got = found(
        spark,
        items,
        [
            "Lead in. " + SHORT + " And on.",
            "Quiz: " + NAMES + " again.",
            NUMBERS,
            SHORT.lower() + " " + NAMES.lower(),
            # placeholders alone never match
            "Who painted the Blue Boy?",
            "21 22 23 24 25 26 27 28 29 30",
            "Jack Smart, Mark James, Paul Black and Alma Green sat in Milan, Italy in June 1998",
        ],
    )
    assert got[0, 1] == (1, 1, True) and got[1, 2] == (9, 9, True) and got[2, 3] == (2, 2, True)
    assert (3, 1) in got and (3, 2) in got and all(d <= 3 for d, _ in got)


LONG = (
    "The old mill stands by the river. Every spring, the water rises to the second step; then the miller, Tom Baker, "
    "opens 3 gates. How many gates are open after 5 days, if nobody closes one at night? (Answer in words.) "
    "Show each step of your work and say why the order of the steps does not change the result in the end."
)


def test_other_punctuation_and_quotations(spark):
    items = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    words = LONG.split()
    texts = [
        LONG.replace(",", "").replace(".", "").replace(";", ""),
        "As they say: \u201c" + LONG + "\u201d",
        "before it " + " ".join(words[10:23]) + " and after",
        " ".join(words[: len(words) // 2]),
        # twelve words in a row are too few
        "before it " + " ".join(words[10:22]) + " and after",
        "... -- !! ?",
    ]
    got = found(spark, items, texts)
    assert set(got) == {(d, 1) for d in range(4)}
    assert got[0, 1][0] == got[0, 1][1] == got[1, 1][0] and all(v[2] for v in got.values())
    assert found(spark, items.selectExpr("item_id", "'?! - ...' text"), ["?! - ...", "a"]) == {}
