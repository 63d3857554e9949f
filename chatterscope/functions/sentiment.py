"""Lexicon sentiment as a Spark expression.

The rules follow the published description of rule-based valence scoring (Hutto and Gilbert, ICWSM
2014): dictionary valence, capitals, degree words, negation, a contrast word and punctuation. Left
out: idioms, `least`, `never so`, `without doubt` and emoji descriptions.
"""

from dataclasses import dataclass, field

from pyspark.sql import functions as F

from chatterscope.functions.lookup import bind, literal_lookup
from chatterscope.functions.text import WHITESPACE, _col

# The characters stripped from the edges of a word.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# English words that strengthen (+0.293) or weaken (-0.293) a following word.
STRONGER = (
    "absolutely amazingly awfully completely considerable considerably decidedly deeply effing "
    "enormous enormously entirely especially exceptional exceptionally extreme extremely fabulously "
    "flipping flippin frackin fracking fricking frickin frigging friggin fully fuckin fucking "
    "fuggin fugging greatly hella highly hugely incredible incredibly intensely major majorly more "
    "most particularly purely quite really remarkably so substantially thoroughly total totally "
    "tremendous tremendously uber unbelievably unusually utter utterly very"
).split()
WEAKER = (
    "almost barely hardly kinda kindof kind-of less little marginal marginally occasional "
    "occasionally partly scarce scarcely slight slightly somewhat sorta sortof sort-of"
).split()

# English words that negate a following word.
NEGATORS = (
    "aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't didn't "
    "doesn't dont hadnt hasnt havent isnt mightnt mustnt neither don't hadn't hasn't haven't isn't "
    "mightn't mustn't neednt needn't never none nope nor not nothing nowhere oughtnt shant "
    "shouldnt uhuh wasnt werent oughtn't shan't shouldn't uh-uh wasn't weren't without wont "
    "wouldnt won't wouldn't rarely seldom despite"
).split()


def _english_degrees():
    return {w: 0.293 for w in STRONGER} | {w: -0.293 for w in WEAKER}


@dataclass(frozen=True)
class Rules:
    """Words and constants of the scorer. The constants are fixed values of the published rules."""

    degrees: dict = field(default_factory=_english_degrees)
    negators: tuple = tuple(NEGATORS)
    contrast: str = "but"
    capitals: float = 0.733
    negation: float = -0.74
    # Weight of a degree word one, two and three places before the scored word.
    distance: tuple = (1.0, 0.95, 0.9)
    before_contrast: float = 0.5
    after_contrast: float = 1.5
    exclamation: float = 0.292
    max_exclamations: int = 4
    question: float = 0.18
    many_questions: float = 0.96
    normalizer: float = 15.0


def sentiment_label(c, pos=0.05, neg=-0.05):
    """Strict limits: a score of exactly 0.05 or -0.05 is neutral."""
    c = _col(c)
    return F.when(c > pos, "positive").when(c < neg, "negative").otherwise("neutral")


def event_hit(tags):
    return F.coalesce(F.size(_col(tags)) > 0, F.lit(False))


# Words with a core of three characters or more lose the punctuation around it; shorter ones keep it,
# which preserves emoticons.
_EDGE = "[" + "".join("\\" + c for c in PUNCTUATION) + "]"
_BLACK = WHITESPACE.replace("[", "[^", 1)
_INSIDE = _EDGE.replace("[", _BLACK[:-1], 1)
_WORD = f"(?<!{_BLACK}){_EDGE}*({_INSIDE}{_BLACK}+{_INSIDE}){_EDGE}*(?!{_BLACK})"


def raw_words(text):
    """The pieces between white space, in order."""
    return F.array_remove(F.split(text, f"{WHITESPACE}+"), "")


def bare_words(text):
    """Lowercase words without the punctuation at their edges, in order."""
    return raw_words(F.regexp_replace(F.lower(text), _WORD, "$1"))


def is_capitals(w):
    return (w == F.upper(w)) & (w != F.lower(w))


def capital_words(text):
    """The raw words of a text that mixes capitals with other words, else null."""
    raw = F.when(text != F.lower(text), raw_words(text))
    return bind(raw, lambda r: F.when(F.exists(r, lambda w: ~is_capitals(w)), r))


def capital_at(capitals, place):
    return F.coalesce(is_capitals(F.get(capitals, place)), F.lit(False))


def toward(value, amount):
    """`amount` with the sign of `value`."""
    return F.when(value > 0, F.lit(amount)).otherwise(F.lit(-amount))


def is_negator(word, rules):
    return F.contains(word, F.lit("n't")) | word.isin(list(rules.negators))


def punctuation_emphasis(text, rules):
    def count(mark):
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    questions = count("?")
    return F.least(count("!"), F.lit(rules.max_exclamations)) * rules.exclamation + (
        F.when(questions <= 1, F.lit(0.0))
        .when(questions <= 3, questions * rules.question)
        .otherwise(F.lit(rules.many_questions))
    )


def contrast_weight(place, contrast_place, rules):
    """Weight of the word at 1-based `place`; `contrast_place` is 0 without a contrast word."""
    return (
        F.when((contrast_place == 0) | (place == contrast_place), F.lit(1.0))
        .when(place < contrast_place, F.lit(rules.before_contrast))
        .otherwise(F.lit(rules.after_contrast))
    )


def after_previous_word(valence, known, capital, degree, negator, weight, rules):
    """Valence of a word after looking at one earlier word that is not in the lexicon itself."""
    signed = F.when(valence < 0, -degree).otherwise(degree)
    louder = signed + F.when(capital, toward(valence, rules.capitals)).otherwise(F.lit(0.0))
    shifted = valence + F.when(degree.isNull(), F.lit(0.0)).otherwise(louder * weight)
    return F.when(known, valence).otherwise(
        shifted * F.when(negator, F.lit(rules.negation)).otherwise(F.lit(1.0))
    )


def normalized(total, emphasis, rules):
    """Sum of valences to a score in [-1, 1] with four decimals.

    The sum is cut to nine decimals first, so that valences which cancel out are not given a sign by
    the order in which they were added.
    """

    def score(t):
        louder = t + F.when(t > 0, emphasis).when(t < 0, -emphasis).otherwise(F.lit(0.0))
        return bind(louder, lambda s: s / F.sqrt(s * s + rules.normalizer))

    squashed = bind(F.round(total, 9), score)
    return F.round(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), squashed)), 4)


def compound(text, lexicon, rules=None):
    """Sentiment in [-1, 1] of a text column; null and empty texts score 0.

    `lexicon` is a dict token -> valence of up to MAX_LITERAL_ENTRIES entries, which becomes a part of the plan. One pass over the words, without
    shuffle or Python workers, so it also runs on streams. See `functions.vocabulary` for the faster form, and for larger lexicons.
    """
    rules = rules or Rules()
    valence_of = literal_lookup(lexicon)
    degree_of = literal_lookup(rules.degrees)

    def word_score(valence, i, words, valences, capitals):
        def look_back(result, place, weight):
            def step(v, w):
                known, negator = F.get(valences, place).isNotNull(), is_negator(w, rules)
                moved = after_previous_word(
                    v, known, capital_at(capitals, place), degree_of(w), negator, weight, rules
                )
                # Most words change nothing; finding that out first is the cheapest way.
                plain = w.isNull() | (degree_of(w).isNull() & ~negator)
                return F.when(plain, v).otherwise(moved)

            return bind(result, lambda v: bind(F.get(words, place), lambda w: step(v, w)))

        result = valence + F.when(
            capital_at(capitals, i), toward(valence, rules.capitals)
        ).otherwise(F.lit(0.0))
        for back, weight in enumerate(rules.distance, start=1):
            result = look_back(result, i - back, weight)
        return F.when(degree_of(F.get(words, i)).isNotNull(), F.lit(0.0)).otherwise(result)

    def total(words, capitals, cut):
        def scores(valences):
            return F.transform(
                valences,
                lambda v, i: F.when(v.isNull(), F.lit(0.0)).otherwise(
                    word_score(v, i, words, valences, capitals) * contrast_weight(i + 1, cut, rules)
                ),
            )

        def summed(valences):
            found = F.array_remove(scores(valences), 0.0)
            total = F.aggregate(found, F.lit(0.0), lambda acc, x: acc + x)
            return F.when(F.array_max(valences).isNull(), F.lit(0.0)).otherwise(total)

        return bind(F.transform(words, valence_of), summed)

    def of_words(words, capitals):
        cut = F.array_position(words, rules.contrast).cast("int")
        return bind(cut, lambda c: total(words, capitals, c))

    text = F.coalesce(_col(text), F.lit(""))
    summed = bind(
        bare_words(text), lambda w: bind(capital_words(text), lambda c: of_words(w, c))
    )
    return normalized(summed, punctuation_emphasis(text, rules), rules)
