"""SQL building blocks for the checks: the same inputs and steps, written independently."""

POSTS = """
base AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS id,
    CASE WHEN doc_id % 2 = 0 THEN 'submission' ELSE 'comment' END AS type,
    source AS subreddit, 'u' || CAST(doc_id % 25 AS VARCHAR) AS author,
    1704067200 + (doc_id * 79193) % 5184000 AS created_utc, text,
    'https://example.org/p/' || CAST(doc_id AS VARCHAR) AS url,
    CASE WHEN doc_id % 17 = 0 THEN NULL ELSE CAST((doc_id * 37) % 31 AS INT) END AS score,
    CASE WHEN doc_id % 2 = 0 THEN CAST((doc_id * 13) % 50 AS INT) END AS num_comments,
    CASE WHEN doc_id % 2 = 1 THEN 't3_' || CAST(doc_id - 1 AS VARCHAR) END AS parent_id,
    CAST(NULL AS VARCHAR) AS brand,
    1704067260 + (doc_id * 79193) % 5184000 + doc_id % 300 AS fetched_at,
    CASE WHEN doc_id % 5 = 0 THEN NULL
         WHEN doc_id % 3 = 0 THEN 'https://example.org/p/' || CAST(doc_id AS VARCHAR)
         ELSE '/p/' || CAST(doc_id AS VARCHAR) END AS permalink
  FROM documents),
posts AS (
  SELECT id, type, subreddit, author, created_utc, text, url, score, num_comments, parent_id, brand,
    fetched_at, permalink FROM base
  UNION ALL
  SELECT id, type, subreddit, author, created_utc, text, url, score + 1, num_comments, parent_id,
    brand, fetched_at + 3600, permalink FROM base WHERE doc_id % 10 = 0)"""

CLEAN = POSTS + r""",
clean AS (
  SELECT id, type, subreddit, author, created_utc, url, score, num_comments, parent_id, fetched_at,
    permalink, regexp_replace(text, '[ \t\n\x0b\f\r]+', ' ', 'g') AS text,
    make_timestamp(created_utc * 1000000) AS event_ts,
    CAST(make_timestamp(created_utc * 1000000) AS DATE) AS event_date
  FROM posts),
dated AS (
  SELECT *, strftime(event_date, '%Y') AS year, strftime(event_date, '%m') AS month,
    strftime(event_date, '%d') AS day FROM clean)"""

UNIQUE = CLEAN + """,
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY created_utc DESC, fetched_at DESC) AS rn
  FROM dated),
uniq AS (SELECT * FROM numbered WHERE rn = 1)"""

TAGGED = UNIQUE + """,
found AS (
  SELECT *, lower(text) LIKE '%oning%' OR lower(text) LIKE '%thble%' AS kw1,
    lower(text) LIKE '%mentre%' OR lower(text) LIKE '%license%' AS kw2,
    lower(text) LIKE '%ingre%' AS kw3,
    lower(subreddit) IN ('src1', 'src12') AS hint1, lower(subreddit) = 'src2' AS hint2,
    concat_ws(',', CASE WHEN lower(text) LIKE '%@%' THEN '@' END,
      CASE WHEN lower(text) LIKE '%ingre%' THEN 'ingre' END,
      CASE WHEN lower(text) LIKE '%onnd%' THEN 'onnd' END,
      CASE WHEN lower(text) LIKE '%tion%' THEN 'tion' END,
      CASE WHEN lower(text) LIKE '%zzznone%' THEN 'zzznone' END) AS tags
  FROM uniq),
tagged AS (
  SELECT f.* EXCLUDE (rn), b.brand FROM found f, (VALUES ('src1'), ('src2'), ('gamma')) b(brand)
  WHERE (b.brand = 'src1' AND (kw1 OR hint1)) OR (b.brand = 'src2' AND (kw2 OR hint2))
    OR (b.brand = 'gamma' AND kw3))"""

LEXICON = """
lexicon(token, valence) AS (VALUES ('thth', 2.1e0), ('onon', -1.7e0), ('erre', -2.4e0),
  ('anea', 1.3e0), ('ing', -0.9e0), ('es', 0.4e0), ('attion', 1.9e0), ('annt', -2.2e0),
  ('hent', 1.2e0), ('oument', 2.3e0), ('letre', -1.2e0), ('erlich', 1.6e0), ('einch', -1.5e0),
  ('las', 0.8e0), ('ue', -0.7e0)),
degrees(token, degree) AS (VALUES ('thly', 0.293e0), ('at', 0.293e0), ('la', 0.293e0),
  ('mit', -0.293e0), ('it', -0.293e0))"""


def _step(back, weight):
    v, w = f"v{back - 1}", f"w{back}"
    return f"""CASE WHEN {w} IS NULL OR val{back} IS NOT NULL THEN {v} ELSE
      ({v} + CASE WHEN deg{back} IS NULL THEN 0e0 ELSE
        (CASE WHEN {v} < 0 THEN -deg{back} ELSE deg{back} END
         + CASE WHEN cap{back} THEN CASE WHEN {v} > 0 THEN 0.733e0 ELSE -0.733e0 END ELSE 0e0 END)
        * {weight}e0 END)
      * CASE WHEN {w} IN ('thnt', 'an', 'è', 'a') OR contains({w}, 'n''t')
        THEN -0.74e0 ELSE 1e0 END END AS v{back}"""


def scores(source, key="id", text="text"):
    """CTEs ending in scores(id, compound) for the rows of a relation with a unique key."""
    lags = ",\n    ".join(
        f"lag(word, {b}) OVER p AS w{b}, lag(val, {b}) OVER p AS val{b}, "
        f"lag(deg, {b}) OVER p AS deg{b}, lag(cap, {b}) OVER p AS cap{b}"
        for b in (1, 2, 3)
    )
    return (
        LEXICON
        + rf""",
pieces AS (
  SELECT {key} AS id, string_split_regex(regexp_replace({text},
    '^[\s\x0b\x1c-\x1f\x85\p{{Z}}]+|[\s\x0b\x1c-\x1f\x85\p{{Z}}]+$', '', 'g'),
    '[\s\x0b\x1c-\x1f\x85\p{{Z}}]+') AS ws FROM {source}),
words AS (SELECT id, unnest(ws) AS raw, generate_subscripts(ws, 1) AS place FROM pieces),
bare AS (
  SELECT id, place, raw = upper(raw) AND raw <> lower(raw) AS capital,
    CASE WHEN length(trim(lower(raw), '!"#$%&''()*+,-./:;<=>?@[\]^_`{{|}}~')) <= 2 THEN lower(raw)
      ELSE trim(lower(raw), '!"#$%&''()*+,-./:;<=>?@[\]^_`{{|}}~') END AS word
  FROM words),
per_text AS (
  SELECT id, bool_or(NOT capital) AS mixed,
    min(CASE WHEN word = 'thin' THEN place END) AS cut FROM bare GROUP BY id),
known AS (
  SELECT b.id, b.place, b.word, b.capital AND t.mixed AS cap, t.cut, l.valence AS val,
    d.degree AS deg
  FROM bare b JOIN per_text t ON b.id = t.id LEFT JOIN lexicon l ON b.word = l.token
    LEFT JOIN degrees d ON b.word = d.token),
context AS (
  SELECT *, {lags}
  FROM known WINDOW p AS (PARTITION BY id ORDER BY place)),
s0 AS (
  SELECT *, val + CASE WHEN cap THEN CASE WHEN val > 0 THEN 0.733e0 ELSE -0.733e0 END
    ELSE 0e0 END AS v0 FROM context WHERE val IS NOT NULL AND deg IS NULL),
s1 AS (SELECT *, {_step(1, "1")} FROM s0),
s2 AS (SELECT *, {_step(2, "0.95")} FROM s1),
s3 AS (SELECT *, {_step(3, "0.9")} FROM s2),
sums AS (
  SELECT id, sum(v3 * CASE WHEN cut IS NULL OR place = cut THEN 1e0 WHEN place < cut THEN 0.5e0
    ELSE 1.5e0 END ORDER BY place) AS s FROM s3 GROUP BY id),
marks AS (
  SELECT {key} AS id, length({text}) - length(replace({text}, '!', '')) AS ep,
    length({text}) - length(replace({text}, '?', '')) AS qm FROM {source}),
loud AS (
  SELECT m.id, round(coalesce(s, 0e0), 9) AS s, least(ep, 4) * 0.292e0
    + CASE WHEN qm <= 1 THEN 0e0 WHEN qm <= 3 THEN qm * 0.18e0 ELSE 0.96e0 END AS emphasis
  FROM marks m LEFT JOIN sums u ON m.id = u.id),
totals AS (
  SELECT id, CASE WHEN s > 0 THEN s + emphasis WHEN s < 0 THEN s - emphasis ELSE s END AS t
  FROM loud),
scores AS (SELECT id, round(t / sqrt(t * t + 15e0), 4) + 0e0 AS compound FROM totals)"""
    )


# Scores have four decimals, so their mean can be rounded to eight in whole numbers, without noise.
_UNITS = "sum(CAST(round(compound * 10000) AS BIGINT))"
MEAN = f"""(CASE WHEN {_UNITS} < 0 THEN -1 ELSE 1 END)
  * ((abs({_UNITS}) * 20000 + count(*)) // (2 * count(*))) / 1e8"""

LABEL = "CASE WHEN compound > 0.05 THEN 'positive' WHEN compound < -0.05 THEN 'negative' ELSE 'neutral' END"

SCORED = (
    TAGGED
    + ",\nmentioned AS (SELECT DISTINCT id, text FROM tagged),"
    + scores("mentioned")
    + f""",
scored AS (
  SELECT t.*, s.compound, {LABEL} AS sentiment, tags <> '' AS event_hit
  FROM tagged t JOIN scores s ON t.id = s.id)"""
)

DAILY = SCORED + f""",
daily AS (
  SELECT brand, event_date, count(*) AS mentions, {_UNITS} / count(*) / 1e4 AS avg_compound,
    {MEAN} AS mean_compound,
    count(*) FILTER (WHERE sentiment = 'positive') AS positive,
    count(*) FILTER (WHERE sentiment = 'negative') AS negative,
    count(*) FILTER (WHERE sentiment = 'neutral') AS neutral,
    count(*) FILTER (WHERE event_hit) AS event_hits,
    count(*) FILTER (WHERE tags <> '') AS event_posts, max(score) AS max_score,
    strftime(event_date, '%Y') AS year, strftime(event_date, '%m') AS month
  FROM scored GROUP BY brand, event_date)"""

TOPS = SCORED + """,
ranked AS (
  SELECT *, dense_rank() OVER (PARTITION BY brand, year, month ORDER BY score DESC NULLS LAST) AS k
  FROM scored),
tops AS (SELECT * FROM ranked WHERE k <= 20)"""

LINK = """CASE WHEN coalesce({0}, '') = '' THEN '' WHEN lower({0}) LIKE 'http%' THEN {0}
  ELSE 'https://reddit.com' || {0} END"""

EXCERPT = r"""substr(regexp_replace(replace({0}, chr(10), ' '),
  '^[\s\x0b\x1c-\x1f\x85\p{{Z}}]+|[\s\x0b\x1c-\x1f\x85\p{{Z}}]+$', '', 'g'), 1, {1})"""

BEST = SCORED + f""",
placed AS (
  SELECT brand, event_date, {LINK.format('permalink')} AS top_permalink,
    {EXCERPT.format('text', 400)} AS top_text,
    row_number() OVER (PARTITION BY brand, event_date ORDER BY score DESC NULLS LAST, id) AS place
  FROM scored),
best AS (SELECT brand, event_date, top_permalink, top_text FROM placed WHERE place = 1)"""


def select(ctes, body):
    return f"WITH {ctes}\n{body}"
