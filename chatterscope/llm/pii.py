"""Personal data: an Aho-Corasick automaton finds anchors; local parsers expand them to spans and validate them.

Anchors are the at-sign, the plus sign, schemes and cues of accounts. Numbers without a cue (cards, network
addresses) are found at their digits. Kinds: email, ip, card, phone (the base kinds), login (user and password in
an address with a scheme), account (after a cue; a valid IBAN or 6 to 34 digits or letters with at least 6 digits).
"""

import hashlib
import re

import ahocorasick
from pyspark.sql import DataFrame, functions as F

from chatterscope.llm.batches import with_result

KINDS = ("email", "ip", "card", "phone", "login", "account")
BASE = KINDS[:4]
SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://", "postgres://", "mysql://", "redis://")
CUES = ("iban", "account", "acct", "ssn", "passport")

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Digits are taken whole (possessive), and places inside a run are skipped, so that long runs cost no more.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
LOGIN = re.compile(r"[^\s/@:]++:[^\s/@]++@")
ACCOUNT = re.compile(r"(?:[\x20]?(?:no\.?|number|nr\.?))?[\x20:=#\"']{1,4}([A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]{1,4}){3,8}|[A-Z0-9-]{6,34})(?![A-Za-z0-9])")


def automaton():
    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    found.add_word("+", ("phone", 1))
    for kind, words in (("login", SCHEMES), ("account", CUES)):
        for word in words:
            for form in {word, word.upper(), word.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid_iban(text):
    text = text.replace(" ", "")
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", text):
        return False
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def digits_of(text):
    return [c for c in text if "0" <= c <= "9"]


def expand_email(text, at, floor):
    """The address around an at-sign; its left part must not reach before `floor`."""
    begin = at
    while begin > floor and LOCAL.match(text[begin - 1]):
        begin -= 1
    domain = DOMAIN.match(text, at + 1)
    return (begin, domain.end()) if begin < at and domain else None


def find(text, anchors):
    """Sorted (kind number, start, end) of all spans of a text."""
    spans = []
    end_of = dict.fromkeys(KINDS, 0)
    for last, (kind, size) in anchors.iter(text):
        at = last + 1 - size
        if at < end_of[kind]:
            continue  # inside the span before
        if kind == "email":
            span = expand_email(text, at, end_of["email"])
            if span:
                end_of[kind] = span[1]
                spans.append((0, *span))
        elif kind == "phone":
            match = PHONE.match(text, at)
            if match:
                end_of[kind] = match.end()
                if 8 <= len(digits_of(match[0])) <= 15:
                    spans.append((3, at, match.end()))
        elif kind == "login":
            match = LOGIN.match(text, last + 1)
            if match:
                end_of[kind] = match.end()
                spans.append((4, match.start(), match.end() - 1))
        elif not text[at - 1 : at].isalnum():
            match = ACCOUNT.match(text, last + 1)
            if match and (valid_iban(match[1]) or len(digits_of(match[1])) >= 6):
                end_of[kind] = match.end()
                spans.append((5, *match.span(1)))
    for match in IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for part in match[0].split(".") if (p := part.lstrip("0"))):
            spans.append((1, *match.span()))
    for match in CARD.finditer(text):
        digits = digits_of(match[0]) if match.end() - match.start() >= 16 else ()
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, *match.span()))
    return sorted(spans)


def show(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def mask(text, spans):
    """text with each span replaced by its kind in angle brackets; where spans overlap, they are one, and the first
    kind names it."""
    out, done, held = [], 0, None
    for begin, end, kind in sorted((a, b, k) for k, a, b in spans):
        if held and begin < held[1]:
            held = (held[0], max(end, held[1]), held[2])
            continue
        if held:
            out += [text[done : held[0]], f"<{KINDS[held[2]].upper()}>"]
            done = held[1]
        held = (begin, end, kind)
    if held:
        out += [text[done : held[0]], f"<{KINDS[held[2]].upper()}>"]
        done = held[1]
    return "".join(out) + text[done:]


SCHEMA = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, masked string"


def personal_data(docs: DataFrame, name="pii") -> DataFrame:
    """docs with a struct column: base counts, digest of the base spans, all spans (code points, end exclusive)
    and the masked text.

    A null or empty text has no spans (masked: empty). All columns and rows stay; a column called `name` is replaced.
    """

    def scan(texts):
        anchors, rows = automaton(), []
        for text in texts:
            spans = find(text, anchors)
            kinds = [s[0] for s in spans]
            base = [s for s in spans if s[0] < len(BASE)]
            digest = hashlib.sha256(show(base).encode()).hexdigest()
            rows.append((*(kinds.count(k) for k in range(len(BASE))), digest, show(spans), mask(text, spans)))
        return rows

    return with_result(docs, scan, SCHEMA, name)


def mask_documents(docs: DataFrame) -> DataFrame:
    """docs with masked texts; the same columns, null texts stay null."""
    found = personal_data(docs.select(F.struct("*").alias("row"), "text"))
    masked = F.when(F.col("text").isNotNull(), F.col("pii.masked"))
    return found.select(*[
        masked.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns
    ])
