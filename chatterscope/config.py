"""Brand configuration: loading, defaults, keyword hygiene and the dimension frames."""

import json
from dataclasses import dataclass, field

from pyspark.sql import functions as F


def clean_keywords(words):
    """Strip, drop blanks, lowercase, keep the first of equal words."""
    cleaned = (w.strip().lower() for w in words or [] if w and w.strip())
    return list(dict.fromkeys(cleaned))


@dataclass(frozen=True)
class Brand:
    name: str
    canonical: str
    keywords: tuple = ()
    events: tuple = ()


@dataclass(frozen=True)
class Config:
    brands: tuple
    subreddits: tuple = ("all",)
    global_events: tuple = ()
    # Lowercased words used for substring tests, in the order in which they are reported.
    event_words: tuple = field(init=False)

    def __post_init__(self):
        if not self.brands:
            raise ValueError("the configuration must define at least one brand")
        words = [e.lower() for b in self.brands for e in b.events if e]
        words += [e.lower() for e in self.global_events if e]
        object.__setattr__(self, "event_words", tuple(dict.fromkeys(words)))

    def keywords_of(self, name):
        """Keywords of the first brand with this name or canonical form; empty if there is none."""
        for brand in self.brands:
            if brand.name == name or brand.canonical == str(name).lower():
                return [k for k in brand.keywords if k]
        return []


def parse_config(raw):
    raw = raw or {}
    brands = tuple(
        Brand(
            name=b.get("name"),
            canonical=(b.get("canonical") or b.get("name")).lower(),
            keywords=tuple(b.get("keywords") or ()),
            events=tuple(b.get("events") or ()),
        )
        for b in raw.get("brands") or ()
    )
    subreddits = tuple(s.strip() for s in raw.get("subreddits") or () if s and s.strip())
    return Config(brands, subreddits or ("all",), tuple(raw.get("global_events") or ()))


def load_config(path):
    """Read a YAML or JSON file on the driver; it is small by nature."""
    with open(path, encoding="utf-8") as handle:
        if str(path).endswith(".json"):
            return parse_config(json.load(handle))
        try:
            import yaml
        except ImportError as err:
            raise RuntimeError("YAML configuration needs PyYAML; use a .json file instead") from err
        return parse_config(yaml.safe_load(handle))


def config_frames(spark, cfg):
    """The configuration as frames: brands, keywords, events and subreddits."""
    brands = [
        (i, b.name, b.canonical, list(b.keywords), list(b.events)) for i, b in enumerate(cfg.brands)
    ]
    keywords = [
        (i, b.canonical, k.lower()) for i, b in enumerate(cfg.brands) for k in b.keywords if k
    ]
    return {
        "brand_dim": spark.createDataFrame(
            brands,
            "position int, name string, canonical string, keywords array<string>, events array<string>",
        ),
        "keyword_dim": spark.createDataFrame(
            keywords, "position int, canonical string, keyword string"
        ).distinct(),
        "event_dim": spark.createDataFrame(
            list(enumerate(cfg.event_words)), "position int, event string"
        ),
        "subreddit_dim": spark.createDataFrame([(s,) for s in cfg.subreddits], "subreddit string"),
    }


def brand_keywords(brand_dim, name):
    """Keywords of the first brand in the dimension with this name or canonical form, one per row."""
    return (
        brand_dim.where((F.col("name") == name) | (F.lower("canonical") == str(name).lower()))
        .orderBy("position")
        .limit(1)
        .select(F.explode("keywords").alias("keyword"))
        .where(F.col("keyword") != "")
    )
