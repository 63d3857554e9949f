import hashlib
import re

from chatterscope.llm import decontamination as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOW))


def brute(docs, items, size):
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, t in items:
            v = words(t)
            n = min(size, len(v))
            for window in {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else ():
                for i in range(len(w) - n + 1):
                    if tuple(w[i : i + n]) == window:
                        hit |= set(range(i, i + n))
                        ids.add(item)
        names = sorted(str(i) for i in ids if i is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=str)


def case(spark, frame, rng, odd_texts, **options):
    letters = ["a", "B", "c", "É", "d7", "e"]
    text = lambda n: rng.choice([" ", ", "]).join(rng.choice(letters) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([0, 1, 2, 3, 5, 6, 9])] + [(7, None), (None, "c c c"), (3, "d7 d7 a")]
    docs = [(i, t) for i, t in enumerate([text(rng.randint(0, 30)) for _ in range(60)] + odd_texts)]
    docs += docs[:5] + [(None, "a b c d7"), (3, "another text c c c")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = d.contamination(frame(docs, "1 AS words"), bench, size=3, **options).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items, 3)


def test_against_brute_force(spark, frame, rng, odd_texts):
    case(spark, frame, rng, odd_texts)


def test_windows_in_parts_give_the_same(spark, frame, rng, odd_texts):
    case(spark, frame, rng, odd_texts, copy_bytes=700)


def test_nothing_to_look_for(spark, frame):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in d.contamination(frame(["a b", None]), none).collect()] == [0, 0]
    assert d.contamination(frame([]), none).count() == 0


def test_drop_and_remove(spark, frame):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    docs = frame(["x A, b; c y", "a b", None, "x A, b; c y"], "'k' AS mark")
    kept = d.drop_contaminated(docs, bench, size=3)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert {(r.doc_id, r.text) for r in d.remove_spans(docs, bench, size=3).collect()} == {(0, "x y"), (3, "x y")}
