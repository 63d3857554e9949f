import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.plain import plain_compound

from chatterscope.functions.sentiment import Rules, compound
from chatterscope.functions.vocabulary import compound_by_vocabulary, distinct_words
from chatterscope.operators import scoring
from chatterscope.sources.tables import read_lexicon

LEXICON = {
    "good": 1.9, "great": 3.1, "bad": -2.5, "horrible": -2.5, "happy": 2.7, "sad": -2.1, "fun": 2.3,
    ":)": 2.0, "ok": 0.9,
}

GOLDEN = [
    (None, 0.0),
    ("", 0.0),
    ("unknown words only", 0.0),
    ("The food is good.", 0.4404),
    ("The food is not good.", -0.3412),
    ("This isn't good at all", -0.3412),
    ("The food is very good!!!", 0.6211),
    ("not very good", -0.3865),
    ("bad????", -0.6662),
    ("bad??", -0.594),
    ("it is good but horrible", -0.5859),
]


@pytest.mark.parametrize("text,score", GOLDEN)
def test_plain_loop_gives_published_scores(text, score):
    assert plain_compound(text, LEXICON) == score


def test_golden(column):
    got = column(lambda c: compound(c, LEXICON), [t for t, _ in GOLDEN])
    assert got == [s for _, s in GOLDEN]


def test_capitals_count_only_next_to_other_words(column):
    mixed, alone, calm = column(lambda c: compound(c, LEXICON), ["GREAT food", "GREAT FOOD", "great food"])
    assert mixed > calm == alone


def test_short_cores_keep_their_punctuation(column):
    got = column(lambda c: compound(c, LEXICON), ["day :)", "ok.", "ok", "(good)", "--good--"])
    assert [g != 0 for g in got] == [True, False, True, True, True]


_WORDS = st.sampled_from(
    ["good", "GOOD", "bad", "Bad.", "very", "VERY", "not", "isn't", "but", "x", "THE", ":)", "ok.",
     "(great)!", "kinda", "sad?", "fun,", "never", "a", "...", "happy!!", " ", "é"]
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(_WORDS, max_size=14).map(" ".join), min_size=20, max_size=60))
def test_spark_agrees_with_the_plain_loop(column, texts):
    got = column(lambda c: compound(c, LEXICON), texts)
    assert got == [plain_compound(t, LEXICON) + 0.0 for t in texts]


def _texts(spark, n=400):
    import random

    rng = random.Random(5)
    words = ["good", "GOOD", "bad", "very", "not", "but", "x", "THE", ":)", "(great)!", "kinda", "sad?"]
    rows = [(str(i), " ".join(rng.choices(words, k=rng.randrange(30)))) for i in range(n)]
    return spark.createDataFrame([*rows, ("n", None), ("e", ""), (None, "very good")], "id string, text string")


def test_both_forms_agree_however_rows_are_spread(spark):
    df = _texts(spark)
    table = spark.createDataFrame([*LEXICON.items(), ("good", 1.9)], "token string, valence double")
    want = {r["id"]: plain_compound(r["text"], LEXICON) for r in df.collect()}
    for frame in (
        scoring.score_posts(df, LEXICON),
        scoring.score_posts(df.repartition(13), LEXICON),
        scoring.score_by_join(df, table),
        scoring.score_by_join(df.repartition(3, "text"), table),
        scoring.score_by_words(df, table),
    ):
        assert {r["id"]: r["compound"] for r in frame.collect()} == want


def test_large_lexicons_are_joined(spark, monkeypatch):
    df = _texts(spark, 60)
    table = spark.createDataFrame(list(LEXICON.items()), "token string, valence double")
    want = {r["id"]: plain_compound(r["text"], LEXICON) for r in df.collect()}
    monkeypatch.setattr("chatterscope.functions.lookup.MAX_BROADCAST_ROWS", 3)
    assert scoring.lexicon_dict(table) is None
    got = scoring.score_posts(df, table)
    assert {r["id"]: r["compound"] for r in got.collect()} == want
    assert set(got.columns) == {"id", "text", "compound", "sentiment"}


def test_no_python_worker_and_no_shuffle(spark):
    """The expression stays in the JVM; by vocabulary, texts go through one Arrow function, and neither shuffles."""
    df = _texts(spark, 5)
    plan = df.select(compound("text", LEXICON))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.split("Scan")[0] and "Exchange" not in plan
    plan = scoring.score_posts(df, LEXICON)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(_WORDS, max_size=14).map(" ".join), min_size=20, max_size=60))
def test_vocabulary_agrees_with_the_plain_loop(column, texts):
    got = column(lambda c: compound_by_vocabulary(c, LEXICON), texts)
    assert got == [plain_compound(t, LEXICON) + 0.0 for t in texts]


def test_vocabulary_of_odd_texts(column, monkeypatch):
    texts = [None, "", " ", "\u2003good\u00a0BAD\x1cgood\u2028x", "good" * 3, "ÉS IST good", "İ good", "...good...", ")good(", "a!b good!!!!!! ??", "x" * 5_000,
             "Good but GOOD but bad", "isn't very very GOOD", "good\x0bnot\x85good", "very", "not", "ΑΣ good"]
    want = column(lambda c: compound(c, LEXICON), texts)
    assert column(lambda c: compound_by_vocabulary(c, LEXICON), texts) == want
    monkeypatch.setattr("chatterscope.functions.vocabulary.PIECE", 10)
    assert column(lambda c: compound_by_vocabulary(c, LEXICON), texts) == want
    rules = Rules(degrees={"muy": 0.293}, negators=("no",), contrast="pero")
    other = ["muy good", "no good", "good pero bad", "MUY good no bad"]
    assert column(lambda c: compound_by_vocabulary(c, LEXICON, rules), other) == column(lambda c: compound(c, LEXICON, rules), other)


def test_distinct_words(spark):
    df = spark.createDataFrame([("Good good... (GOOD) :)",), (None,), ("bad\u2003ok. bad,",)], "text string")
    assert sorted(r[0] for r in distinct_words(df).collect()) == [":)", "bad", "good", "ok."]


def test_words_of_the_texts_decide_how_a_lexicon_is_joined(spark, monkeypatch):
    """A lexicon that is too large to be copied, of which the texts have few words; ids are null or repeat."""
    df = _texts(spark, 50).withColumn("id", F.when(F.col("id") > "3", "same"))
    big = spark.createDataFrame([*LEXICON.items(), *((f"w{i}", 1.0) for i in range(300))], "token string, valence double")
    monkeypatch.setattr("chatterscope.functions.lookup.MAX_BROADCAST_ROWS", 100)
    got = scoring.score_posts(df, big).select("text", "compound").collect()
    assert len(got) == df.count() and all(r["compound"] == plain_compound(r["text"], LEXICON) for r in got)


def test_plugged_scorer(spark):
    def score(texts):
        if any("boom" in t for t in texts):
            raise ValueError("boom")
        return [len(t) / 10 for t in texts]

    df = spark.createDataFrame([(1, "abc"), (2, None), (3, "boom"), (4, "")], "i int, text string")
    got = scoring.score_posts(df, scorer=scoring.pandas_scorer(score)).orderBy("i").collect()
    assert [r["compound"] for r in got] == [0.3, 0.0, 0.0, 0.0]
    assert [r["sentiment"] for r in got] == ["positive", "neutral", "neutral", "neutral"]


def test_read_lexicon(spark, tmp_path):
    (tmp_path / "lexicon.txt").write_text('good\t1.9\t0.9\t[1, 2]\n:)\t2.0\t1.1\t[2]\n"x\t-1.5\t0.2\t[1]\n')
    got = read_lexicon(spark, str(tmp_path / "lexicon.txt")).collect()
    assert {r["token"]: r["valence"] for r in got} == {"good": 1.9, ":)": 2.0, '"x': -1.5}


def test_other_rules(column):
    rules = Rules(degrees={"muy": 0.293}, negators=("no",), contrast="pero")
    texts = ["muy good", "no good", "good pero bad"]
    got = column(lambda c: compound(c, LEXICON, rules), texts)
    assert got == [plain_compound(t, LEXICON, rules) for t in texts]


def test_provider_falls_back(spark):
    rows = [(1, "good", '{"compound": 0.1, "relevancy": 0.9}'), (2, "good", None), (3, "", '{"compound": 1}')]
    df = spark.createDataFrame(rows, "i int, text string, response string")
    got = scoring.with_provider(df, "gemini", LEXICON).orderBy("i").collect()
    assert [(r["compound"], r["relevancy"]) for r in got] == [(0.1, 0.9), (0.4404, None), (0.0, None)]
    plain = scoring.with_provider(df, "lexicon", LEXICON)
    assert "relevancy" not in plain.columns
    assert plain.where(F.col("i") == 1).first()["compound"] == 0.4404


def test_only_words_that_may_be_tokens_get_a_row(spark):
    texts = [(1, "one two three good, five SIX but bad"), (2, None), (None, "good"), (4, "nothing here " * 500)]
    df = spark.createDataFrame(texts, "id long, text string")
    tokens = spark.createDataFrame([("good",), ("bad",), (None,), ("",)], "token string")
    rows = scoring.word_rows(df, "id", "text", Rules(), tokens)
    hits = [tuple(r[:3]) + (r["w0"][0], r["w1"][0], r["w2"][1]) for r in rows.collect() if r["w0"][0] in ("good", "bad")]
    assert rows.count() < 20 and len(hits) == 3
    assert {h[0]: h for h in hits if h[3] == "good"} == {1: (1, 4, 7, "good", "three", False), None: (None, 1, 0, "good", None, False)}
    assert [h for h in hits if h[3] == "bad"] == [(1, 8, 7, "bad", "but", True)]
