from pyspark.sql import functions as F

from chatterscope.functions import keys, sentiment, text, times
from chatterscope.functions.lookup import literal_lookup


def test_collapse_ws(column):
    assert column(text.collapse_ws, ["a\t b\n\nc", " a ", "a b", None]) == ["a b c", " a ", "a b", None]


def test_label_limits_are_strict(column):
    scores = [0.05, -0.05, 0.0501, -0.0501, 0.0]
    assert column(sentiment.sentiment_label, scores, "double") == [
        "neutral", "neutral", "positive", "negative", "neutral",
    ]


def test_compound_label_rounds_like_the_stored_value(column):
    values = [0.0625, 0.1875, 0.0045, 0.0015, -0.0625, -0.0001, 0.25, 1.0, -1.0, 0.9996, 0.00049999, None]
    got = column(lambda c: text.compound_label(c, F.lit("v")), values, "double")
    assert got == [f"{v or 0.0:.3f} (v)" for v in values]


def test_compound_label_many(column):
    values = [i / 20000 for i in range(-20000, 20001, 7)]
    assert column(text.thousandths, values, "double") == [
        round(abs(float(f"{v:.3f}")) * 1000) for v in values
    ]


def test_permalink(column):
    got = column(text.absolute_permalink, [None, "", "/r/x", "HTTP://x", "https://y"])
    assert got == ["", "", "https://reddit.com/r/x", "HTTP://x", "https://y"]


def test_markdown_link(column):
    assert column(text.markdown_link, [None, "u"]) == ["", "[Open](u)"]


def test_excerpt(column):
    assert column(text.excerpt, ["a\nb ", "x" * 401, None, "é" * 500]) == ["a b", "x" * 400, "", "é" * 400]


def test_submission_text(spark):
    df = spark.createDataFrame(
        [("t", "b"), (" t", None), (None, None), (" t", "b ")], "title string, body string"
    )
    got = [r[0] for r in df.select(text.submission_text("title", "body")).collect()]
    assert got == ["t\nb", "t", "", "t\nb"]


def test_epoch_seconds(column):
    values = ["1730000000", "1730000000123", "2025-01-02T03:04:05Z", "junk", None, "1d", "NaN", " 12.5 "]
    assert column(times.to_epoch_seconds, values) == [
        1730000000.0, 1730000000.0, 1735787045.0, None, None, None, None, 12.5,
    ]
    as_long = column(lambda c: times.to_epoch_seconds(c, "bigint"), [1730000000123, 5], "bigint")
    assert as_long == [1730000000.0, 5.0]


def test_live_key(spark):
    rows = [
        (" a", "/p", "u", 5, "s", "x"), ("  ", " /p ", "u", 5, "s", "x"), (None, "", "u ", 5, "s", "x"),
        (None, None, " ", 5, "s", None),
    ]
    df = spark.createDataFrame(
        rows, "id string, permalink string, url string, created_utc long, subreddit string, author string"
    )
    assert [r[0] for r in df.select(keys.live_key(df)).collect()] == [
        "id: a", "permalink:/p", "url:u", "ts:5:sr:s:a:",
    ]


def test_live_key_without_columns(spark):
    df = spark.createDataFrame([(7, "s")], "fetched_at long, subreddit string")
    assert df.select(keys.live_key(df)).first()[0] == "ts:7:sr:s:a:"


def test_substring_and_word_match(column):
    values = ["noted", "a note!", "#nike x", "@nike", "énike", "nikes", "c++ rocks", "c+", None, "NIKE"]
    sub = column(lambda c: text.contains_any(c, ["note", "Nike"]), values)
    assert sub == [True, True, True, True, True, True, False, False, False, True]
    word = column(lambda c: text.word_match(c, ["note", "nike", "c++"]), values)
    assert word == [False, True, True, True, False, False, True, False, False, True]
    assert column(lambda c: text.word_match(c, [" ", ""]), ["", "x"]) == [False, False]
    assert column(lambda c: text.contains_any(c, []), ["", "x"]) == [False, False]


def test_brand_hit_is_leftmost_and_first_listed(column):
    values = ["an Air Jordan by NIKE INC", "nike inc", "none", None]
    got = column(lambda c: text.brand_hit(c, ["nike", "nike inc", "air jordan"]), values)
    assert got == ["air jordan", "nike", "", ""]


def test_lookup(column):
    for size in (0, 1, 4, 5, 3000):
        words = {f"wörd{i}": float(i) for i in range(size)}
        got = column(literal_lookup(words), ["wörd0", "wörd4", "wörd2999", "x", "", None])
        assert got == [words.get("wörd0"), words.get("wörd4"), words.get("wörd2999"), None, None, None]


def test_event_hit(column):
    assert column(sentiment.event_hit, [["a"], [], None], "array<string>") == [True, False, False]
