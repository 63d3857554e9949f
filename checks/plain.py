"""The scoring rules as a plain loop over words, to check and to time the Spark form against."""

import math
import re
import string

from chatterscope.functions.sentiment import Rules

WHITE = re.compile(r"[\s\x0b\x1c-\x1f\x85 ]+")


def bare(word):
    core = word.strip(string.punctuation)
    return word if len(core) <= 2 else core


def plain_compound(text, lexicon, rules=None):
    rules = rules or Rules()
    raw = [w for w in WHITE.split(text or "") if w]
    words = [bare(w.lower()) for w in raw]
    capital = [w.isupper() for w in raw]
    mixed = any(capital) and not all(capital)
    cut = words.index(rules.contrast) if rules.contrast in words else None
    total = 0.0
    for i, word in enumerate(words):
        if word not in lexicon or word in rules.degrees:
            continue
        v = lexicon[word]
        if capital[i] and mixed:
            v += rules.capitals if v > 0 else -rules.capitals
        for back in range(1, min(i, 3) + 1):
            before = words[i - back]
            if before in lexicon:
                continue
            if before in rules.degrees:
                shift = rules.degrees[before] * (-1 if v < 0 else 1)
                if capital[i - back] and mixed:
                    shift += rules.capitals if v > 0 else -rules.capitals
                v += shift * rules.distance[back - 1]
            if before in rules.negators or "n't" in before:
                v *= rules.negation
        if cut is not None and i != cut:
            v *= rules.before_contrast if i < cut else rules.after_contrast
        total += v
    total = round(total, 9)
    marks, asked = (text or "").count("!"), (text or "").count("?")
    emphasis = min(marks, rules.max_exclamations) * rules.exclamation
    if asked > 1:
        emphasis += asked * rules.question if asked <= 3 else rules.many_questions
    total += emphasis if total > 0 else -emphasis if total < 0 else 0.0
    return round(total / math.sqrt(total * total + rules.normalizer), 4)
