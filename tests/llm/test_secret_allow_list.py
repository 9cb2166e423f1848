import random
import string

import pytest

from strata.llm.secret_scan import is_placeholder, made_of_words, redact_secrets

HEAD, BODY, SIGN = "Hq3ZtX7vLm9KpW2sRb5YcD8", "Bk7Yd2Fs9GhJ3LmN5PqR8TvWxZ4", "Uw4Nf6Jg1QxVz0TkEo8aMiPdhCr"
ONE = "Zx9Qw3Rt7Yp1Lk5Mn8Bv2Cd4"


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (f"jwt {HEAD}.{BODY}.{SIGN} end", "jwt [ENTROPY].[ENTROPY].[ENTROPY] end"),
        (f"SG.{ONE}.{SIGN}", "SG.[ENTROPY].[ENTROPY]"),
        (f"ya29.{ONE}", "ya29.[ENTROPY]"),
        (f"at @{ONE} x", "at @[ENTROPY] x"),
        (f"see https://example.org/?t={HEAD}.{SIGN}", "see https://example.org/?[ENTROPY].[ENTROPY]"),
        # letters only, and one digit
        ("key xKqPzLmWvTrYbNcHdJfG end", "key [ENTROPY] end"),
        ("key xKqPzLmWv7TrYbNcHdJf end", "key [ENTROPY] end"),
        # addresses and names
        (f"see https://a.b.org/{ONE} x", None),
        (f"see www.host.org/{ONE}, x", None),
        (f"mail name@{ONE.lower()}.org now", None),
        ("call getCustomerOrderHistoryByName now", None),
        ("usr/local/lib/python3/site-packages/numbers", None),
    ],
)
def test_dotted_and_letters_only_secrets(spark, text, want):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert redact_secrets(docs).first()["text"] == (want or text)


def test_few_random_strings_read_like_words():
    rng = random.Random(5)
    for alphabet, share in ((string.ascii_letters + string.digits, 0.01), (string.ascii_letters, 0.06)):
        words = ["".join(rng.choices(alphabet, k=20)) for _ in range(2000)]
        assert sum(map(made_of_words, words)) <= share * len(words)


def test_an_address_is_one_however_long_its_path(spark):
    path = "/".join(["part"] * 900) + "/"
    docs = spark.createDataFrame(
        [(1, f"see https://a.b.org/{path}.{ONE} x"), (2, f"see https://a.b.org/part/.{ONE} x"), (3, f"at {path}.{ONE} x")],
        "doc_id long, text string",
    )
    kept = {r["doc_id"]: "[ENTROPY]" not in r["text"] for r in redact_secrets(docs).collect()}
    assert kept == {1: True, 2: True, 3: False}


@pytest.mark.parametrize(
    ("word", "placeholder"),
    [
        ("your-sample-api-key-goes-here", True), ("example_example_example_1", True), ("abcdefgh12345678abcdefgh", True),
        (f"{ONE}sample", False), (f"example{HEAD}", False), (ONE, False),
    ],
)
def test_placeholders_hide_no_random_rest(word, placeholder):
    assert is_placeholder(word) == placeholder
