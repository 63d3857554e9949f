import textwrap

import pytest

from chatterscope.llm import licenses as lic

TEXT = dict(lic.SENTENCES)


def scan(frame, texts, **options):
    return [tuple(r.licence) for r in sorted(lic.licences(frame(texts, "1 AS licence"), **options).collect(), key=lambda r: r.doc_id)]


def test_sequences_and_order(frame):
    three = " ".join(TEXT[k] for k in ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ENDORSE"))
    two = " ".join(TEXT[k] for k in ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY"))
    rows = scan(frame, [
        "Some words.\nreleased   UNDER the MIT licence, or so.\nReleased under the MIT license.\nMore.",
        three, two, three + "\n" + two,
        "Licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3.",
        "no licence here", None, "", "All rights reserved. All rights reserved. All rights reserved.",
    ])
    assert [r[1] for r in rows] == [
        "MIT", "BSD-3-Clause", "BSD-2-Clause", "BSD-3-Clause,BSD-2-Clause", "GPL-3.0-only,CC-BY-NC-4.0", "", "", "", "Proprietary",
    ]
    assert rows[1][0] == "BSD-GRANT,BSD-SOURCE,BSD-BINARY,BSD-ENDORSE" and rows[3][2] == 2


def test_every_known_sentence_has_a_cue_and_is_one_sentence(frame):
    rows = scan(frame, [t for _, t in lic.SENTENCES])
    for (number, _), row in zip(lic.SENTENCES, rows):
        assert row[0] == number


def test_odd_texts(frame, odd_texts):
    assert {r[0] for r in scan(frame, odd_texts)} == {""}
    assert scan(frame, []) == []


def wrapped(*names, leader="", width=60):
    """The named sentences hard-wrapped, a paragraph each, every line after a comment leader."""
    lines = [line for k in names for line in [*textwrap.wrap(TEXT[k], width), ""]]
    return "\n".join(leader + line for line in lines)


@pytest.mark.parametrize("leader", ["", " * ", "# ", "// ", ";; ", "! ", "-- "])
def test_wrapped_notices(frame, leader):
    mit = ("MIT-GRANT", "MIT-NOTICE", "AS-IS")
    bsd = ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ENDORSE")
    gpl = ("GPL-FREE", "GPL-NOWARRANTY")
    head = f"{leader}Copyright (c) 2020 A. Person\n"
    rows = scan(frame, [
        f"{leader}The MIT License\n{leader}\n" + wrapped(*mit, leader=leader),
        head + wrapped(*bsd, leader=leader), head + wrapped(*bsd[:3], leader=leader).replace("\n", "\r\n"),
        "words before.\n" + wrapped(*gpl, leader=leader, width=33) + "\nwords after", wrapped(gpl[0], leader=leader, width=20),
    ])
    assert [r[1] for r in rows] == ["MIT", "BSD-3-Clause", "BSD-2-Clause", "GPL-3.0-or-later", "GPL-3.0-or-later"]
    assert rows[0][0] == ",".join(mit) and rows[1][0] == ",".join(bsd)


def test_numbered_clauses_and_gaps(frame):
    first, source, binary = (TEXT[k] for k in ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY"))
    rows = scan(frame, [
        "\n".join([*textwrap.wrap(first, 50), *textwrap.wrap("1. " + source, 50), *textwrap.wrap("2. " + binary, 50)]),
        "Copyright 2020 A\nAll   rights\n# reserved.", "All \trights  reserved.", "Dedicated to the public\n  domain under CC0 1.0.",
        "Terms of the Mozilla Public License.\nThis Source Code Form is subject to the terms of the Mozilla Public License, v.\n2.0.",
        "Released under the\n\nMIT License.", "not Released under\nthe MIT License.", "Released under the MIT\nLicense\nor not",
    ])
    assert [r[1] for r in rows] == ["BSD-2-Clause", "Proprietary", "Proprietary", "CC0-1.0", "MPL-2.0", "", "", "MIT"]


def test_marks_in_texts_end_nothing(frame):
    rows = scan(frame, ["A license.\u0001Released under the MIT License.", "a\u0002Released under the MIT License.\u0002"])
    assert [r[1] for r in rows] == ["", ""]


def test_sentences_without_a_usual_cue_are_found(frame):
    """The words that a text must hold to be cut come from the sentences that are passed."""
    sentences = [("X-1", "Do as you like with it."), ("X-2", "Beer is owed."), *lic.SENTENCES]
    rules = [("Beerware", ("X-1", "X-2")), *lic.RULES]
    rows = scan(frame, ["do as YOU like, with it!\nBeer is owed", "do as you like", "Released under the MIT License."], sentences=sentences, rules=rules)
    assert rows == [("X-1,X-2", "Beerware", 1), ("", "", 0), ("MIT-REF", "MIT", 1)]
    alone = scan(frame, ["a\nBeer is owed.\nb"], sentences=sentences[1:2], rules=[("B", ("X-2",))])
    assert alone == [("X-2", "B", 1)]


def test_every_sentence_has_a_derived_cue():
    import re

    known = {lic.plain_normalised(t) for _, t in lic.SENTENCES} | {"a", "of it"}
    pattern = re.compile(lic.cues(known))
    assert all(pattern.search(s) for s in known)


def by_lists(lines):
    """Identifiers and licences of one sentence a line, by dictionaries and lists."""
    known = {}
    for number, sentence in lic.SENTENCES:
        known.setdefault(" ".join("".join(c if c.isalnum() else " " for c in sentence.lower()).split()), number)
    ids = [known[key] for key in (" ".join("".join(c if c.isalnum() else " " for c in x.lower()).split()) for x in lines) if key in known]
    rest, found = list(ids), []
    for licence, order in lic.RULES:
        i = 0
        while i + len(order) <= len(rest):
            if rest[i : i + len(order)] == order:
                rest[i : i + len(order)] = [None]
                found += [licence] if licence not in found else []
            i += 1
    return ",".join(ids), ",".join(found), len(found)


def test_against_lists(frame, rng):
    other = ["Some other sentence.", "The mill stands by the river!", "released under the sea.", "12 apples"]
    texts = []
    for _ in range(200):
        lines = [rng.choice(lic.SENTENCES)[1] if rng.random() < 0.7 else rng.choice(other) for _ in range(rng.randint(0, 9))]
        for _ in range(rng.randint(0, 2)):  # whole sequences, so that long rules match too
            at = rng.randint(0, len(lines))
            lines[at:at] = [TEXT[k] for k in rng.choice(lic.RULES)[1]]
        # Not those with a colon, which closes a sentence before a capital.
        texts.append([x.upper() if rng.random() < 0.2 and ":" not in x else x for x in lines])
    want = [by_lists(lines) for lines in texts]
    assert scan(frame, ["\n".join(lines) for lines in texts]) == want and len({w[1] for w in want}) > 20
