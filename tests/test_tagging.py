import pytest
from pyspark.sql import functions as F

from chatterscope.config import Config, Brand, brand_keywords, clean_keywords, config_frames, load_config, parse_config
from chatterscope.operators import tagging

CFG = parse_config(
    {
        "brands": [
            {"name": "Apple", "keywords": ["apple", "iPhone"], "events": ["launch", "beta"]},
            {"name": "Nike", "canonical": "NIKE", "keywords": ["nike", "air jordan"], "events": ["Drop"]},
        ],
        "subreddits": [" Apple ", "nikeapple", "tech"],
        "global_events": ["leak", "launch"],
    }
)

ROWS = [
    ("0", "nothing here", "tech"),
    ("1", "my iphone", "tech"),
    ("2", "NIKE and Apple launch", "tech"),
    ("3", "a drop", "tech"),
    ("4", "hello", "APPLE"),
    ("5", "pineapple beta leak", "nikeApple"),
    ("6", None, None),
    ("7", "air\U0001f600 jordan Air Jordan", "other"),
]
BRANDS = [[], ["apple"], ["apple", "nike"], [], [], ["apple"], [], ["nike"]]
HINTED = [[], ["apple"], ["apple", "nike"], [], ["apple"], ["apple", "nike"], [], ["nike"]]
EVENTS = [[], [], ["launch"], ["drop"], [], ["beta", "leak"], [], []]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "id string, text string, subreddit string")


def _by_id(df, name):
    return [r[name] for r in sorted(df.collect(), key=lambda r: r["id"])]


def test_brands_in_both_modes(rows):
    assert _by_id(tagging.match_brands(rows, CFG), "brands") == BRANDS
    assert _by_id(tagging.match_brands(rows, CFG, mode="join"), "brands") == BRANDS


def test_join_mode_without_broadcast(rows, monkeypatch):
    monkeypatch.setattr("chatterscope.functions.lookup.MAX_BROADCAST_ROWS", 1)
    assert _by_id(tagging.match_brands(rows, CFG, mode="join"), "brands") == BRANDS
    assert _by_id(tagging.match_events(rows, CFG, mode="join"), "event_tags") == EVENTS


def test_events_need_no_brand(rows):
    assert _by_id(tagging.match_events(rows, CFG), "event_tags") == EVENTS
    assert _by_id(tagging.match_events(rows, CFG, mode="join"), "event_tags") == EVENTS


@pytest.mark.parametrize("method", ["index", "join"])
def test_tables_with_null_and_repeated_ids(spark, method):
    terms = spark.createDataFrame(
        [(2, "b", "Oning"), (1, "a", "mentre"), (1, "a", "men"), (3, "b", "é\u00df"), (4, "c", ""), (5, "long", "x" * 60)],
        "position int, canonical string, keyword string")
    texts = ["oning", "mentre", None, "", "oning MENTRE", "ÉSS éß", "x" * 59, "x" * 61 + "oning", "oning"]
    for ids in ([None] * len(texts), ["7"] * len(texts), ["1", None] * 5):
        rows = spark.createDataFrame([(i, n, t) for n, (i, t) in enumerate(zip(ids, texts))], "id string, n int, text string")
        got = {r["n"]: r["brands"] for r in tagging.match_terms(rows, terms, method=method).collect()}
        assert got == {0: ["b"], 1: ["a"], 2: [], 3: [], 4: ["a", "b"], 5: ["b"], 6: [], 7: ["b", "long"], 8: ["b"]}


@pytest.mark.parametrize("method", ["index", "join"])
def test_empty_tables(spark, rows, method):
    none = spark.createDataFrame([], "position int, canonical string, keyword string")
    assert _by_id(tagging.match_terms(rows, none, method=method), "brands") == [[]] * 8
    blank = spark.createDataFrame([(1, "a", ""), (2, "b", None)], "position int, canonical string, keyword string")
    assert _by_id(tagging.match_terms(rows, blank, method=method), "brands") == [[]] * 8


def test_posts_tagged_from_tables(spark, rows):
    dims = config_frames(spark, CFG)
    hints = tagging.subreddit_hints(dims["brand_dim"], dims["subreddit_dim"])
    tagged = tagging.tag_posts(rows, tables=tagging.KeywordTables(dims["keyword_dim"], dims["event_dim"], hints))
    assert _by_id(tagged, "brands") == HINTED and _by_id(tagged, "event_tags") == EVENTS
    bare = tagging.tag_posts(rows, tables=tagging.KeywordTables(dims["keyword_dim"]))
    assert _by_id(bare, "brands") == BRANDS and _by_id(bare, "event_tags") == [[]] * 8


def test_hints_as_dict_and_as_table(spark, rows):
    tagged = tagging.match_brands(rows, CFG)
    hints = tagging.hints_of(CFG)
    assert hints == {"apple": ["apple"], "nikeapple": ["apple", "nike"]}
    assert _by_id(tagging.add_hints(tagged, hints), "brands") == HINTED
    dims = config_frames(spark, CFG)
    table = tagging.subreddit_hints(dims["brand_dim"], dims["subreddit_dim"])
    assert {(r[0], r[1]) for r in table.collect()} == {(s, b) for s, bs in hints.items() for b in bs}
    assert _by_id(tagging.add_hints(tagged, table), "brands") == HINTED


def test_explode_replaces_the_noted_brand(rows):
    tagged = tagging.tag_posts(rows.withColumn("brand", F.lit("old")), CFG)
    got = sorted((r["id"], r["brand"]) for r in tagging.explode_brands(tagged).collect())
    assert got == [(i, b) for (i, *_), bs in zip(ROWS, HINTED) for b in bs]


def test_tagging_twice_changes_nothing(rows):
    once = tagging.tag_posts(rows, CFG)
    assert _by_id(tagging.tag_posts(once, CFG), "brands") == _by_id(once, "brands")


def test_substring_join_against_brute_force(spark):
    texts = ["abcabc", "xxabx", "", "ÄÖü", "a", "\U0001f600b?c", "b\n?c"]
    terms = ["a", "ab", "abcab", "bca", "öü", "?c", "b?c", "b\n?", "\U0001f600b", "zzzzz", "abcabcabc"]
    left = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    right = spark.createDataFrame([(t,) for t in terms], "term string")
    got = {(r["i"], r["term"]) for r in tagging.substring_join(left, "i", "text", right, "term").collect()}
    assert got == {(i, t) for i, x in enumerate(texts) for t in terms if t in x.lower()}


def test_substring_join_without_terms(spark):
    left = spark.createDataFrame([(1, "x")], "i int, text string")
    none = spark.createDataFrame([], "term string")
    assert tagging.substring_join(left, "i", "text", none, "term").columns == ["i", "term"]
    assert tagging.substring_join(left, "i", "text", none, "term").count() == 0


def test_no_nested_loop_join(spark, rows):
    plan = tagging.match_brands(rows, CFG, mode="join")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_extract_brand(spark):
    df = spark.createDataFrame([("my NIKE shoe",), ("nikes",), (None,)], "text string")
    assert [r["brand"] for r in tagging.extract_brand(df, ["nike"]).collect()] == ["nike"]


def test_config_defaults(tmp_path):
    path = tmp_path / "c.yml"
    path.write_text("brands:\n  - name: Big Co\n    keywords: [big]\nsubreddits: ['', ' a ']\n")
    cfg = load_config(str(path))
    assert cfg == Config((Brand("Big Co", "big co", ("big",)),), ("a",))
    assert parse_config({"brands": [{"name": "x"}]}).subreddits == ("all",)
    with pytest.raises(ValueError):
        parse_config({})


def test_json_config(tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"brands": [{"name": "x", "keywords": ["Y"]}]}')
    assert load_config(path).brands[0].keywords == ("Y",)


def test_brand_keywords(spark):
    dim = config_frames(spark, CFG)["brand_dim"]
    assert [r[0] for r in brand_keywords(dim, "Nike").collect()] == ["nike", "air jordan"]
    assert [r[0] for r in brand_keywords(dim, "APPLE").collect()] == ["apple", "iPhone"]
    assert brand_keywords(dim, "none").count() == 0
    assert CFG.keywords_of("nike") == ["nike", "air jordan"] and CFG.keywords_of("zz") == []


def test_clean_keywords():
    assert clean_keywords([" A", "", None, "a", "b "]) == ["a", "b"]


def test_config_frames(spark):
    dims = config_frames(spark, CFG)
    assert [r["event"] for r in dims["event_dim"].orderBy("position").collect()] == ["launch", "beta", "drop", "leak"]
    assert dims["keyword_dim"].count() == 4


def test_tables_too_large_to_copy_find_the_same(spark, monkeypatch):
    monkeypatch.setattr("chatterscope.functions.lookup.MAX_BROADCAST_ROWS", 3)
    terms = [(i, f"c{i}", k) for i, k in enumerate(["ab", "é", "abc" * 30, "bcab", "", "zz", None, "aB"])]
    terms = spark.createDataFrame(terms, "position int, canonical string, keyword string")
    texts = [("xAby",), (None,), ("",), ("abc" * 40,), ("été",), ("nothing",), ("xAby",)]
    found = tagging.match_terms(spark.createDataFrame(texts, "text string"), terms).collect()
    want = {"xAby": ["c0", "c7"], None: [], "": [], "abc" * 40: ["c0", "c2", "c3", "c7"], "été": ["c1"], "nothing": []}
    assert len(found) == 7 and all(r["brands"] == want[r["text"]] for r in found)
