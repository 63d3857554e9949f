"""Secret scans: fixed patterns, and two character Markov models compared by log-likelihood ratio.

Base kinds: assign, access, hex (patterns). Kind `markov`: tokens of 20 or more characters with a letter and a digit,
whose pairs of characters are likelier under a model of random strings than under one of ordinary identifiers. The
models are trained on a bounded sample of documents. Random strings are the values that the base patterns label as secrets,
and digests of the sample's words in the usual spellings. Ordinary identifiers are these words, and the words put together
with dashes, underscores, capitals, numbers and dates.

Places are worked out from the lengths of the matches and of what lies between them.
"""

import math

from pyspark.sql import DataFrame, Window, functions as F

from chatterscope.llm.common import copied_if_small, text_mark

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)"""
# Shorter runs fail in any case, so the lengths are part of the patterns; runs are entered at their start only.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = (
    r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{20,}"
)
# Words of the training sample.
WORD = r"(?<![A-Za-z0-9+/_=-])[A-Za-z]{2,30}(?![A-Za-z0-9+/_=-])"
KINDS = {"assign": (ASSIGN, 2, 12), "access": (ACCESS, 0, 18), "hex": (HEX, 0, 16), "markov": (TOKEN, 0, 20)}
BASE = ("assign", "access", "hex")

# The bound of the training sample: documents, chosen by a hash of their id.
SAMPLE_DOCS = 4000
# The bound of its words, chosen by a hash of them.
SAMPLE_WORDS = 5000
# Share of a model that is the uniform distribution, so that pairs the sample happens to lack weigh little.
UNIFORM = 0.1
# Natural logarithm of the odds that a token must reach.
THRESHOLD = 7.0


def matches(docs: DataFrame, kinds=KINDS) -> DataFrame:
    """doc_id, mark, kind, start, end, value of each match of docs(doc_id, text), once for repeated rows."""
    read = docs.select("doc_id", "text", text_mark().alias("mark"))
    wanted = [
        F.when(
            F.col("text").rlike(pattern),
            F.arrays_zip(
                F.split("text", pattern, -1).alias("gap"),
                F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("match"),
                F.regexp_extract_all("text", F.lit(pattern), F.lit(group)).alias("value"),
            ),
        )
        for pattern, group, _ in kinds.values()
    ]
    found = read.select(
        "doc_id", "mark", F.posexplode(F.array(*wanted)).alias("k", "found")
    ).where(F.col("found").isNotNull())
    found = found.select("doc_id", "mark", "k", F.posexplode("found").alias("at", "m"))
    found = found.select(
        "doc_id", "mark", "k", "at", F.char_length("m.gap").alias("gap"),
        F.char_length("m.match").alias("length"), F.col("m.value").alias("value"),
    ).dropDuplicates(["doc_id", "mark", "k", "at"])
    upto = Window.partitionBy("doc_id", "mark", "k").orderBy("at")
    end = F.sum(F.col("gap") + F.coalesce("length", F.lit(0))).over(upto)
    least = F.element_at(F.array(*[F.lit(n) for _, _, n in kinds.values()]), F.col("k") + 1)
    name = F.element_at(F.array(*[F.lit(k) for k in kinds]), F.col("k") + 1)
    return (
        found.withColumn("end", end)
        .where(F.col("length").isNotNull() & (F.char_length("value") >= least))
        .select("doc_id", "mark", "k", name.alias("kind"), (F.col("end") - F.col("length")).alias("start"), "end", "value")
    )


def _steps(token):
    """Numbers of the pairs of neighbouring characters of a token, by the alphabet; others count as the last one."""
    def code(at):
        place = F.instr(F.lit(ALPHABET), F.substr(token, at, F.lit(1)))
        return F.when(place > 0, place - 1).otherwise(len(ALPHABET) - 1)

    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.char_length(token) - 1, F.lit(1))),
        lambda i: code(i) * len(ALPHABET) + code(i + 1),
    )


def _identifiers(word):
    """Ordinary identifiers made of a word; only neighbouring characters count, so one word stands for several."""
    code = F.crc32(word.cast("binary"))
    short, number = (F.pmod(code, F.lit(n)).cast("string") for n in (10, 3000))
    two = [F.lpad(F.pmod(F.shiftright(code, k), F.lit(60)).cast("string"), 2, "0") for k in (4, 10, 16)]
    year = F.pmod(code, F.lit(40)) + 1990
    join = F.concat
    return F.array(
        word, F.initcap(word), join(F.lit("_"), word, F.lit("_")), join(F.lit("-"), word, F.lit("-")),
        join(word, short, F.lit("_"), word), join(F.lit("_"), number, F.lit("_"), word), join(word, F.lit("-"), number, F.lit("-")),
        join(F.lit("_v"), short, F.lit("-v"), short, F.lit("_")), join(word, F.initcap(word), number),
        join(F.upper(word), F.lit("_"), F.upper(word), F.lit("-"), short), join(F.lit("/"), word, F.lit("/"), word, F.lit("=")),
        join(year.cast("string"), F.lit("-"), two[0], F.lit("-"), two[1], F.lit("T"), two[2], F.lit("-"), two[0], F.lit("Z")),
    )


def _random_strings(word):
    """Digests of a word, as hex and base 64, also with dashes and in capitals."""
    digest = F.sha2(word.cast("binary"), 256)
    plain = F.rtrim(F.base64(F.unhex(digest)), F.lit("="))
    grouped = F.regexp_replace(digest, "([0-9a-f]{8})", "$1-")
    return F.array(digest, F.upper(digest), plain, F.translate(plain, "+/", "-_"), grouped)


def train(docs: DataFrame, sample=SAMPLE_DOCS, n_words=SAMPLE_WORDS):
    """Log-likelihood ratio of each pair of characters: random strings against ordinary identifiers.

    The sample: documents and words of them, both bounded. Each of the words and each distinct secret counts once. The shares are
    mixed with the uniform distribution, which is also what remains without any sample: all ratios are 0 then.
    """
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    some = docs.select("doc_id", "text").join(copied_if_small(chosen, sample), "doc_id")
    secret = matches(some, {k: KINDS[k] for k in BASE}).select("value").distinct()
    word = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    words = some.select(F.explode(word).alias("word")).distinct().orderBy(F.xxhash64("word"), "word").limit(n_words)
    made = F.array(*[
        F.struct(F.lit(label).alias("label"), tokens.alias("tokens"))
        for label, tokens in ((0, _identifiers(F.col("word"))), (1, _random_strings(F.col("word"))))
    ])
    spelled = words.select(F.explode(made).alias("m")).select("m.label", F.explode("m.tokens").alias("token"))
    found = secret.select(F.lit(1).alias("label"), F.col("value").alias("token"))
    counts = (
        found.unionByName(spelled)
        .where(F.char_length("token") > 1)
        .select("label", F.explode(_steps(F.col("token"))).alias("step"))
        .groupBy("label", "step")
        .count()
        .collect()  # at most two rows for each pair of the alphabet
    )
    n = len(ALPHABET)
    times = [[0] * n * n for _ in range(2)]
    for r in counts:
        times[r["label"]][r["step"]] += r["count"]

    def shares(row):
        total = sum(row)
        return [UNIFORM / n + (1 - UNIFORM) * x / total if total else 1 / n for x in row]

    ratio = []
    for a in range(n):
        plain, random = (shares(t[a * n : (a + 1) * n]) for t in times)
        ratio += [math.log(r / p) for p, r in zip(plain, random)]
    return ratio


def scored(found: DataFrame, ratio) -> DataFrame:
    """found without `markov` rows whose token is likelier an ordinary identifier."""
    table = F.split(F.lit(",".join(f"{x:.5f}" for x in ratio)), ",").cast("array<double>")  # folded to a constant
    total = F.aggregate(
        _steps(F.col("value")), F.lit(0.0), lambda acc, s: acc + F.element_at(table, s + 1)
    )
    return found.where((F.col("kind") != "markov") | (total >= THRESHOLD))


def secrets(docs: DataFrame, ratio=None, sample=SAMPLE_DOCS) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, by start, then kind), n_markov; one row
    for each row of docs. Spans are in code points, end exclusive.

    A null or empty text has no spans. Repeated rows stay repeated, with the same result.
    """
    found = scored(matches(docs), train(docs, sample) if ratio is None else ratio)
    spans = found.groupBy("doc_id", "mark").agg(
        F.array_sort(F.collect_list(F.struct("start", "k", "end", "kind"))).alias("all")
    )
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    nothing = F.array().cast("array<struct<start:bigint,k:int,end:bigint,kind:string>>")
    here = docs.select("doc_id", text_mark().alias("mark")).alias("here")
    there = spans.alias("there")
    same = F.col("here.doc_id").eqNullSafe(F.col("there.doc_id")) & (F.col("here.mark") == F.col("there.mark"))
    rows = here.join(there, same, "left").select("here.doc_id", F.coalesce(F.col("there.all"), nothing).alias("all"))
    count = lambda kind: F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("all", lambda s: s["kind"] != "markov")
    return rows.select(
        "doc_id", *[count(k) for k in BASE], F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("all")).alias("spans"), count("markov"),
    )
