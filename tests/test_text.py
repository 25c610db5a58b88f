import random
import re

import pytest
from pyspark.sql import functions as F

from duolex.functions import text

NB = chr(0xA0)


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "s string").select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("given, want", [
    ("EE.UU.", f"EE.{NB}UU."), ("EE UU", f"EE.{NB}UU."), ("EEUU.", f"EE.{NB}UU."), ("JJ. OO.", f"JJ.{NB}OO."),
    ("AABC", f"AA.{NB}CC."), ("COMMAND", f"COMM.{NB}NN.D"), ("EE  UU", f"EE.{NB}UU."), ("EE.  UU", "EE.  UU"),
    ("AAAAAA", f"AA.{NB}AA.AA"), (f"EE{chr(0x2003)}UU", f"EE.{NB}UU."), ("", ""), (None, None),
])
def test_spanish(spark, given, want):
    assert one(spark, given, text.spanish_plural_abbreviations("s")) == want


def test_spanish_strict(spark):
    strict = text.spanish_plural_abbreviations("s", strict=True)
    assert one(spark, "EE UU y COMMAND AABC", strict) == f"EE.{NB}UU. y COMMAND AABC"


@pytest.mark.parametrize("given, want", [
    ("thru,nite;thru!", "through,night;thru!"), ("Thru thru", "Thru through"), ("thrusts throught", "thrusts through"),
    ("¡nite?", "¡night?"), ("¿nite", "¿nite"), ("thru-nite", "thru-nite"), ("thru\tnite", "thru\tnite"),
    ("(thru) [nite] {thru} \"nite\" 'thru' a/nite\\thru", "(through) [night] {through} \"night\" 'through' a/night\\through"),
])
def test_english(spark, given, want):
    assert one(spark, given, text.english_formalize("s")) == want


def test_clean_pair(spark):
    rows = [
        (0, "SERIES TITLE: a\nb", "Original language summary: c"), (1, "x", "Original language summary: c\nd"),
        (2, None, "SERIES TITLE: y"), (3, "SERIES TITLE", "z\n"),
    ]
    c1, c2 = text.clean_pair("a", "b")
    got = spark.createDataFrame(rows, "i int, a string, b string").select("i", c1.alias("x"), c2.alias("y"))
    assert [(r["x"], r["y"]) for r in got.orderBy("i").collect()] == [
        ("ab", "Original language summary: c"), ("x", "cd"), ("nan", "SERIES TITLE: y"), ("SERIES TITLE", "z")]


def test_tokens_as_in_python(spark):
    random.seed(3)
    alphabet = list("aÉß_9 .!\n\t") + [NB, chr(0x2003), chr(0x1D), chr(0x85), "\U0001F600"]
    rows = [(i, "".join(random.choice(alphabet) for _ in range(random.randint(0, 25)))) for i in range(300)]
    got = spark.createDataFrame(rows, "i int, s string").select(
        "s", text.whitespace_tokens("s").alias("ws"), text.word_tokens("s").alias("w"),
        text.blank_parts("s").alias("n"), text.trigrams("s").alias("g"), text.characters("s").alias("c")).collect()
    for r in got:
        s = r["s"]
        low = s.lower()
        assert r["ws"] == s.split()
        assert r["w"] == re.findall(r"\w+", low)
        assert r["n"] == len(s.split(" "))
        assert r["g"] == [low[i:i + 3] for i in range(len(low) - 2)]
        assert r["c"] == list(s)


def test_sentences(spark):
    assert one(spark, "Hello. You!? yes ", text.split_sentences("s")) == ["Hello.", "You!?", "yes"]
    assert one(spark, "   ", text.split_sentences("s")) == []


def test_label_suffix(spark):
    assert one(spark, "__label__en", text.label_suffix("s")) == "en"


def test_lexicon_general(spark):
    swap = text.replace_tokens("s", {"a": "b", "b": "a"}, [" ", "-"])
    assert one(spark, "a b-a c", swap) == "b a-b c"
    assert one(spark, "zz", F.coalesce(swap)) == "zz"
