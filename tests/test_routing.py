import pytest
from pyspark.sql import functions as F

from duolex.operators import routing


def one(spark, columns, *values):
    schema = ", ".join(f"c{i} string" for i in range(len(values)))
    return spark.createDataFrame([values], schema).select(columns.alias("x")).first()["x"]


@pytest.mark.parametrize("a, b, want", [
    (10, 19, "Ok"), (10, 20, "Check"), (10, 29, "Check"), (10, 30, "Delete"), (0, 0, "Delete"), (0, 5, "Delete"),
    (29, 10, "Check"), (30, 10, "Delete"),
])
def test_ratio(spark, a, b, want):
    assert one(spark, routing.length_ratio("c0", "c1"), "x" * a, "y" * b) == want


@pytest.mark.parametrize("src, tgt, want", [
    ("a b c d", "A B C D", True), ("a b c d e", "A B c d e", False), ("a    ", "A    ", False),
    (routing.MISSING_TOKEN, routing.MISSING_TOKEN, False), ("a b c d e", "x", True), ("a b c d e", None, True),
])
def test_equal_sentences(spark, src, tgt, want):
    assert one(spark, routing.equal_sentences_ok("c0", "c1"), src, tgt) is want


def test_missing_sides_are_equal(spark):
    assert one(spark, routing.equal_pair("c0", "c1"), None, None) is True
    assert one(spark, routing.equal_pair("c0", "c1"), None, "NaN") is True
    assert one(spark, routing.equal_pair("c0", "c1"), None, "") is False


def test_split_threshold(spark):
    def parts(n):
        return " ".join(["w."] * n)

    sents = routing.aligned_sentences("c0", "c1")
    assert len(one(spark, sents, parts(39), parts(39))) == 1
    assert len(one(spark, sents, parts(40), parts(40))) == 40
    assert one(spark, sents, parts(40), parts(39)) is None
    assert one(spark, sents, " " * 60, " " * 60) is None


# lang1, lang2, found1, found2, verdict; `xx`, `yy` stand for languages outside the list
CASES = [
    ("en", "fr", "en", "fr", "keep"), ("en", "fr", "fr", "en", "swap"), ("en", "fr", "en", "de", "delete"),
    ("en", "fr", "de", "fr", "delete"), ("en", "fr", "fr", "fr", "delete"),
    ("en", "xx", "en", "zz", "keep"), ("en", "xx", "xx", "de", "swap"), ("en", "xx", "de", "xx", "delete"),
    ("xx", "en", "xx", "en", "keep"), ("xx", "en", "de", "xx", "swap"), ("xx", "en", "de", "en", "delete"),
    ("xx", "en", "xx", "de", "delete"),
    ("xx", "yy", "en", "en", "keep"), ("xx", "yy", "yy", "xx", "keep"),
]


@pytest.mark.parametrize("case", CASES)
def test_language_verdict(spark, case):
    assert one(spark, routing.language_verdict("c0", "c1", "c2", "c3"), *case[:4]) == case[4]


def test_verdict_of_nothing_found(spark):
    row = spark.range(1).select(
        routing.language_verdict(F.lit("en"), F.lit("fr"), F.lit(None).cast("string"), F.lit("fr")).alias("x"))
    assert row.first()["x"] == "delete"
