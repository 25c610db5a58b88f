from pyspark.sql import functions as F

from duolex.operators import sentences

# Words that end the sentences stand without a stop more often.
LONG = "The house stood there. Nobody came by. We walked on. They left there by day and on we walked as they left. "
GERMAN = "Es war hier. Das es war ist hier klar. No war es hier so. "


def texts(spark):
    rows = [(i, LONG + f"Dr. Who met Mr. Poe at no. {i}. They left.", "en") for i in range(30)]
    rows += [(i, GERMAN + "Das gilt z.B. hier. Das war es.", "de") for i in range(30, 60)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_abbreviations_are_learned_by_language(spark):
    found = {(r["lang"], r["token"]) for r in sentences.learn_abbreviations(texts(spark)).collect()}
    assert {("en", "dr"), ("en", "mr"), ("de", "z.b")} <= found
    assert not found & {("en", "there"), ("en", "left"), ("de", "hier"), ("de", "es"), ("en", "walked")}


def split(spark, rows, known):
    df = spark.createDataFrame([(i, *r, "kept") for i, r in enumerate(rows)], "id long, text string, lang string, known string")
    abbreviations = spark.createDataFrame(known, "lang string, token string")
    out = sentences.split_by_language(df, abbreviations).orderBy("id")
    assert out.columns == ["id", "text", "lang", "known", "sentences"]
    return [r["sentences"] for r in out.collect()]


def test_sentences_by_language(spark):
    text = "Dr. Who came. It cost 3.14 (really?) \"Yes!\" he said... Bye"
    got = split(spark, [(text, "en"), (text, "de"), (text, None), ("A z.B. b. C.", "de"), ("A z.B. b. C.", "en")],
                [("en", "dr"), ("de", "z.b")])
    whole = ["Dr. Who came.", "It cost 3.14 (really?)", '"Yes!"', "he said...", "Bye"]
    assert got[0] == whole
    assert got[1] == got[2] == ["Dr.", "Who came.", *whole[1:]]
    assert got[3:] == [["A z.B. b.", "C."], ["A z.B.", "b.", "C."]]


def test_odd_texts(spark):
    got = split(spark, [(None, "en"), ("", "en"), (" \n\t", "en"), ("...", "en"), ("你好。再见！！ok", "zh"),
                        ("a\nb.\nc", "en"), ("x. " * 3000, "en")], [])
    assert got[0] is None or got[0] == []
    assert got[1:3] == [[], []] and got[3] == ["..."]
    assert got[4] == ["你好。", "再见！！", "ok"] and got[5] == ["a\nb.", "c"]
    assert got[6] == ["x."] * 3000


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    learned = sentences.learn_abbreviations(empty)
    assert learned.count() == 0
    assert sentences.split_by_language(empty, learned).count() == 0


def test_rows_without_language_share_theirs(spark):
    df = texts(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r["token"] for r in sentences.learn_abbreviations(df).collect()} >= {"dr", "z.b"}
