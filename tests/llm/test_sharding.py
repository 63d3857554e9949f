import zlib

from chatterscope.llm import sharding


def shards(docs, n):
    rows = sharding.kd_shards(docs, shards=n).collect()
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    for mine in by.values():
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
    return rows, by


def test_equal_bytes_in_spite_of_a_hot_source(frame, rng):
    texts = [(i, "x" * rng.randint(0, 200)) for i in range(3000)]
    docs = frame(texts).selectExpr("doc_id", "text", "lang", "if(doc_id % 3 = 0, 'hot', source) AS source", "n_chars")
    for n in (8, 5, 1):
        rows, by = shards(docs, n)
        sizes = [sum(r.size for r in mine) for mine in by.values()]
        assert len(rows) == 3000 and len(by) == n and max(sizes) - min(sizes) <= 0.02 * sum(sizes)
    assert {(r.doc_id, r.size, r.text_crc32) for r in rows} == {
        (i, len(t) + 1, zlib.crc32(t.encode())) for i, t in texts
    }


def test_repeatable_and_target_bytes(frame, rng):
    docs = frame([(i, "x" * rng.randint(0, 90)) for i in range(400)])
    first = sharding.kd_shards(docs, target_bytes=3000).collect()
    again = sharding.kd_shards(docs.repartition(7), target_bytes=3000).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
    sizes = {}
    for r in first:
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
    assert max(sizes.values()) < 3600


def test_odd_tables(frame, odd_texts):
    rows, _ = shards(frame([(i, t) for i, t in enumerate(odd_texts)] + [(0, None), (None, "é")], "2 AS node"), 4)
    assert len(rows) == len(odd_texts) + 2
    assert {r.size for r in rows if r.doc_id == 0} == {1} and {r.size for r in rows if r.doc_id is None} == {3}
    assert sharding.kd_shards(frame([]), shards=8).count() == 0
    same, _ = shards(frame([(1, "a")] * 9), 4)
    assert len(same) == 9
    assert sharding.kd_shards(frame(["a", "b"]).select("doc_id", "text"), shards=2).count() == 2


def cuts(rows, leaves, first=0):
    """The shard of each row by sorting: (keys, size, name) in, name -> shard out."""
    if leaves == 1 or not rows:
        return {name: first for _, _, name in rows}
    spread = [max(k[d] >> 31 for k, _, _ in rows) - min(k[d] >> 31 for k, _, _ in rows) for d in range(3)]
    d = spread.index(max(spread))
    rows = sorted(rows, key=lambda r: r[0][d])
    target, below, n = sum(r[1] for r in rows) * (leaves // 2) / leaves, 0, 0
    while below + rows[n][1] < target:
        below, n = below + rows[n][1], n + 1
    n += target - below > below + rows[n][1] - target
    half = leaves // 2
    return cuts(rows[:n], half, first) | cuts(rows[n:], leaves - half, first + half)


def test_cuts_against_sorting(frame, rng):
    docs = frame([(i, "x" * rng.randint(0, 500)) for i in range(300)])
    keyed = [((r.key_lang, r.key_source, r.key_n_chars), r.size, r.doc_id) for r in sharding.coordinates(docs).collect()]
    for leaves in (1, 2, 7, 40):
        got = {r.doc_id: r.shard for r in sharding.kd_shards(docs, shards=leaves).collect()}
        assert got == cuts(keyed, leaves)


def test_many_leaves_in_a_plan_of_constant_size(frame, rng):
    docs = frame([(i, "x" * rng.randint(50, 150)) for i in range(6000)])
    rows, by = {}, {}
    for leaves in (16, 600):
        rows[leaves] = sharding.kd_shards(docs, target_bytes=sum(r.size for r in sharding.coordinates(docs).select("size").collect()) / leaves)
    size = {n: str(df._jdf.queryExecution().analyzed()).count("CASE WHEN") for n, df in rows.items()}
    assert size[16] == size[600]
    for r in rows[600].collect():
        by.setdefault(r.shard, []).append(r)
    sizes = [sum(r.size for r in mine) for mine in by.values()]
    assert len(by) == 600 and max(sizes) < 1.5 * sum(sizes) / 600
    assert all(sorted(r.slot for r in mine) == list(range(len(mine))) for mine in by.values())
