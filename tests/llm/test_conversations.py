import hashlib
import zlib

import pytest

from chatterscope.llm.conversations import Costs, damaged, plain_rows, repaired, summaries

SCHEMA = "conv_id long, turn long, role string, text string, part string, index int"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
FULL = {"u": "user", "a": "assistant"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(kind, text)
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def brute(all_rows, rows, costs=Costs()):
    """The contract, conversation by conversation; rows after damage."""
    result = []
    for conv in {r[0] for r in all_rows}:
        mine = [(t, " " if role is None else role, " " if text is None else text) for c, t, role, text in rows if c == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in mine:
            body = text.strip(" \t\n\v\f\r")
            faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        least = {"": (0, "", ()), "a": (0, "", ())}

        def inserted(best):
            best = dict(best)
            for _ in range(4):
                for x in ("", "s", "u", "a"):
                    y = "a" if x == "u" else "u"
                    if y in best:
                        c, e, out = best[y]
                        best[x] = min(best.get(x, (1 << 60, "", ())), (c + costs.insert, "I" + e, (f"{FULL[y]}:", *out)))
            return best

        least = inserted(least)
        for (_, role, text), fault in reversed(list(zip(mine, faults))):
            found = {}
            for x in ("", "s", "u", "a"):
                options = [(costs.delete + least[x][0], "D" + least[x][1], least[x][2])] if x in least else []
                if fault not in ("b", "d"):
                    more = costs.truncated if fault == "t" else 0
                    y = NEXT.get((x, role[:1]))
                    if y in least:
                        options.append((more + costs.keep + least[y][0], "K" + least[y][1], (f"{role}:{text}", *least[y][2])))
                    y = "a" if x == "u" else "u"
                    options.append((more + costs.rerole + least[y][0], "R" + least[y][1], (f"{FULL[y]}:{text}", *least[y][2])))
                found[x] = min(options)
            least = inserted(found)
        cost, audit, out = least[""]
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(mine, mine[1:])]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
        result.append((conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest))
    return sorted(result, key=str)


def run(spark, rows, damages=True, **more):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    got = summaries(repaired(damaged(df) if damages else plain_rows(df), **more))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def conversation(rng, conv, n, roles=("system", "user", "assistant", "user", "assistant", "tool")):
    texts = ["Yes.", "No!", "Well", "", " \n", "Why?", "é.", "so\n", "one. two"]
    return [(conv, 2 * i if rng.random() < 0.9 else 2 * i + 3, rng.choice(roles), rng.choice(texts) + (str(i) + "." if rng.random() < 0.6 else ""))
            for i in range(n)]


def test_short_conversations(spark, rng):
    rows = [r for c in range(60) for r in conversation(rng, c, rng.randrange(1, 9))]
    assert run(spark, rows) == brute(rows, damage(rows))


@pytest.mark.parametrize("costs", [Costs(), Costs(insert=1, delete=3, rerole=2, truncated=1)])
def test_chunks_of_long_conversations(spark, rng, costs):
    rows = [r for c, n in ((1, 45), (2, 3), (3, 17), (4, 7), (5, 8)) for r in conversation(rng, c, n)]
    assert run(spark, rows, damages=False, costs=costs, chunk_rows=4) == brute(rows, rows, costs)


def test_regular_conversation_in_chunks(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(51)]
    assert run(spark, rows, damages=False, chunk_rows=5) == brute(rows, rows)


def test_odd_rows(spark):
    rows = [
        (None, None, None, None), (None, 1, "user", "a."), (None, None, "user", "b."), (7, 3, "", "c."), (7, 3, "user", "d."),
        (7, 3, "unicorn", "e."), (8, 5, "user", None), (9, 1, None, "x."), (9, 2, "assistant", "z" * 50_000),
        *[(11, 4, "user", "again.")] * 40, *[(12, i, "user", "again.") for i in range(40)], (13, -(2**63), "user", "f."), (13, 2**63 - 1, "assistant", "g."),
    ]
    want = [(*r[:1], min(r[1], 2**63 - 1), *r[2:]) for r in brute(rows, rows)]
    assert run(spark, rows, damages=False, chunk_rows=7) == want
    assert run(spark, rows) == [(*r[:1], min(r[1], 2**63 - 1), *r[2:]) for r in brute(rows, damage(rows))]


def test_empty_and_dropped(spark):
    assert run(spark, []) == []
    dropped = [(c, 1, "user", "a.") for c in range(400) if zlib.crc32(f"{c}:1".encode()) % 20 == 0]
    assert len(dropped) > 3
    nothing = hashlib.sha256(b"").hexdigest()
    assert run(spark, dropped) == sorted([(r[0], 0, 0, 0, 0, 0, 0, "", nothing) for r in dropped], key=str)


def test_output_holds_the_texts(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "user", "b"), (1, 2, "assistant", "c.")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    lines = [x for r in repaired(plain_rows(df)).collect() for x in r["lines"]]
    assert [(x["role"], x["text"]) for x in lines] == [("user", "a."), ("assistant", "c.")]
