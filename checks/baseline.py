"""Native expressions against row-at-a-time Python functions: python -m checks.baseline [folder]"""

import sys
import time

from pyspark.sql import functions as F

from checks import views as V
from checks.plain import plain_compound
from chatterscope.functions.sentiment import compound
from chatterscope.operators.tagging import tag_posts
from chatterscope.session import get_spark


def plain_tags(text, subreddit):
    text, subreddit = (text or "").lower(), (subreddit or "").lower()
    brands = [b.canonical for b in V.CONFIG.brands if any(k.lower() in text for k in b.keywords)]
    brands += [b.canonical for b in V.CONFIG.brands
               if subreddit in {s.lower() for s in V.CONFIG.subreddits} and b.canonical in subreddit]
    events = [e for e in V.CONFIG.event_words if e in text]
    return list(dict.fromkeys(brands)), events


def main(sf="/root/testdata/sf0.1", repeats=3):
    spark = get_spark("baseline", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    score = F.udf(lambda t: plain_compound(t, V.LEXICON, V.RULES), "double")
    tag = F.udf(plain_tags, "struct<brands: array<string>, events: array<string>>")
    posts = V.posts(spark, sf)
    forms = {
        "scan only": posts.select(F.length("text")),
        "sentiment, native": posts.select(compound("text", V.LEXICON, V.RULES)),
        "sentiment, Python function": posts.select(score("text")),
        "tagging, native": tag_posts(posts, V.CONFIG).select("brands", "event_tags"),
        "tagging, Python function": posts.select(tag("text", "subreddit")),
    }
    for name, frame in forms.items():
        times = []
        for _ in range(repeats):
            began = time.perf_counter()
            frame.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        print(f"{name}: best {min(times):.2f} s of {repeats}", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
