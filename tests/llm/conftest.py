import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside, and one with a dot.
CLASHING = "key string, size string, row string, shard string, copies string, kept string, _mark string, fp string, `a.b` string"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empties, ties, repeats, a long text."""
    long = " ".join(f"w{i % 977} x{i * 7919 % 10007}" for i in range(60_000))
    return [
        (1, "the same text here", "en", "a", 18), (2, "the same  text\there\n", "en", "a", 21), (3, "thesametexthere", "en", None, 15),
        (4, None, "en", "b", None), (5, "", None, "b", 0), (6, " \n\t ", "de", "b", 4), (7, "the same text here", "en", "a", 18),
        (7, "the same text here", "en", "a", 18), (None, "no id here", None, None, None), (None, "no id here", "fr", "c", 10),
        (None, "another without id", "fr", "c", 18), (8, long, "en", "c", len(long)), (9, long, "en", "b", len(long)),
        (10, "ünï cödé Straße 日本語 ©", "de", "d", 24), (11, "one", "en", "d", 3), (12, "MIT License!! you IDIOT, you m0ron", "en", "a", 34),
        (10, "a second text of id ten", "de", "d", 23)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, COLUMNS)


@pytest.fixture(scope="session")
def odd_wide(spark, odd_rows):
    return spark.createDataFrame([(*r, *"ABCDEFGHI") for r in odd_rows], f"{COLUMNS}, {CLASHING}")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)
