import random
import re

from pyspark.sql import functions as F

from logilake.llm import license_scan as ls


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    found = [
        (i, label)
        for phrase, label in ls.BASE_PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    places = [i for i, _ in found]
    return len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


def test_base_phrases_agree_with_brute_force():
    rng = random.Random(2)
    pool = "gnu general public license GNU Apache LICENSE cc by mit MIT License cc BY é x1 - , \x85 .cc by".split(" ")
    scanner = ls.Scanner()
    for _ in range(3000):
        text = "".join(rng.choice(pool) + rng.choice([" ", "-", "\n", ""]) for _ in range(rng.randint(0, 30)))
        assert scanner.scan(text)[:5] == brute(text)


def test_expressions():
    assert ls.tag_labels("SPDX-License-Identifier: MIT") == {"mit"}
    text = "# spdx-license-identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0"
    assert ls.tag_labels(text) == {"mit", "apache-2.0", "gpl-2.0-only with classpath-exception-2.0"}
    assert ls.tag_labels("# spdx-license-identifier: MIT and see the LICENSE file") == {"mit"}
    assert ls.tag_labels("SPDX-License-Identifier: MIT.") == {"mit"}
    for broken in ("MIT AND", "(MIT OR ISC", "AND MIT", ")", "(MIT OR ISC) WITH x", "GPL-2.0 WITH a WITH b", "see LICENSE", ""):
        assert ls.tag_labels(f"SPDX-License-Identifier: {broken}") == set(), broken
    node = ls.parse_expression("A OR B AND C")
    assert node.value == "OR" and node.right.value == "AND"


def test_labels_of_the_method_and_score():
    scanner = ls.Scanner()
    both = scanner.scan("Licensed under CC BY-NC 4.0. SPDX-License-Identifier: Zlib")
    assert both.base_labels == "cc-by" and both.labels == "cc-by,cc-by-nc,zlib" and both.score == 1
    assert scanner.scan("no licence")[1:] == (0, None, None, "", "", 0, None)
    assert 0 < scanner.scan("all rights reserved").score < 1
    assert scanner.scan("x " * 200_000 + "MIT License").first_word == 200_000


def test_documents(documents):
    got = {r.doc_id: r for r in ls.scan_licenses(documents((1, None), (2, "MIT license, MIT License"), (3, ""))).collect()}
    assert (got[1].n_words, got[1].labels, got[1].first_word, got[1].score) == (0, "", None, 0)
    assert (got[2].n_base, got[2].first_word, got[2].last_word) == (2, 0, 2)
    assert ls.scan_licenses(documents()).count() == 0


def permitted(expression):
    return ls.Scanner().scan(f"SPDX-License-Identifier: {expression}").permitted


def test_operators_give_different_answers():
    assert permitted("MIT OR GPL-3.0-only") and not permitted("MIT AND GPL-3.0-only")
    assert not permitted("GPL-2.0-only") and permitted("GPL-2.0-only WITH Classpath-exception-2.0")
    assert not permitted("GPL-2.0-only WITH Bootloader-exception") and permitted("Apache-2.0 WITH LLVM-exception")
    # AND binds closer than OR, brackets closer than both.
    assert permitted("MIT OR GPL-3.0-only AND AGPL-3.0-only") and not permitted("(MIT OR GPL-3.0-only) AND AGPL-3.0-only")
    assert permitted("MIT OR Own-License") and not permitted("Own-License") and permitted("(, no value") is None
    assert ls.Scanner().scan("SPDX-License-Identifier: MIT\nSPDX-License-Identifier: GPL-3.0-only").permitted is False


def test_unknown_ids_lower_the_score_and_get_no_label():
    scan = ls.Scanner().scan
    known, partly, none = (scan(f"SPDX-License-Identifier: {x}") for x in ("MIT OR ISC", "MIT OR Nowhere-1.0", "Nowhere-1.0"))
    assert (known.labels, partly.labels, none.labels) == ("isc,mit", "mit", "")
    assert known.score == 1 and 0 < partly.score < 1 and none.score == 0


def descend(tokens):
    """The same language by recursive descent: (value, labels) with value under PERMITTED; None if broken."""
    at = 0

    def peek():
        return tokens[at] if at < len(tokens) else None

    def atom():
        nonlocal at
        token = peek()
        if token is None or token in ("AND", "OR", "WITH", ")"):
            raise ValueError
        at += 1
        if token == "(":
            node = either()
            if peek() != ")":
                raise ValueError
            at += 1
            return (*node, None)
        low = token.lower()
        return low in ls.PERMITTED, {low} & ls.LICENSE_IDS, low

    def pair():
        nonlocal at
        value, labels, name = atom()
        if peek() == "WITH":
            at += 1
            other = peek()
            if name is None or other is None or other in ("AND", "OR", "WITH", "(", ")"):
                raise ValueError
            at += 1
            low = other.lower()
            if low in ls.EXCEPTION_IDS:
                labels = {f"{x} with {low}" for x in labels}
            value = value or (name, low) in ls.PERMITTED_WITH
            if peek() == "WITH":
                raise ValueError
        return value, labels

    def both():
        nonlocal at
        value, labels = pair()
        while peek() == "AND":
            at += 1
            more, others = pair()
            value, labels = value and more, labels | others
        return value, labels

    def either():
        nonlocal at
        value, labels = both()
        while peek() == "OR":
            at += 1
            more, others = both()
            value, labels = value or more, labels | others
        return value, labels

    try:
        found = either()
        # What follows a complete expression is prose, unless it is an operator or a bracket.
        return None if peek() in ("AND", "OR", "WITH", ")") else found
    except ValueError:
        return None


def test_expressions_agree_with_recursive_descent():
    rng = random.Random(6)
    ids = ["MIT", "GPL-2.0-only", "gpl-3.0-or-later", "ISC", "Nowhere", "Classpath-exception-2.0", "GCC-exception-3.1"]
    seen = 0
    for _ in range(5000):
        if rng.random() < 0.5:
            tokens = [rng.choice(ids + ["AND", "OR", "WITH", "(", ")"]) for _ in range(rng.randrange(1, 9))]
        else:
            tokens = grown(rng, ids, 3)
        # A bracket right after a complete expression has no meaning, and one around a side of WITH none of its own.
        if any(b == "(" and a not in ("AND", "OR", "(") or (a, b) == (")", "WITH") for a, b in zip(tokens, tokens[1:])):
            continue
        node = ls.parse_expression(" ".join(tokens))
        got = None if node is None or not ls._valid(node) else (node.permitted(), node.labels())
        assert got == descend(tokens), tokens
        seen += got is not None
    assert seen > 1500


def grown(rng, ids, depth):
    kind = rng.random()
    if depth == 0 or kind < 0.25:
        return [rng.choice(ids)]
    if kind < 0.4:
        return [rng.choice(ids), "WITH", rng.choice(ids)]
    if kind < 0.6:
        return ["(", *grown(rng, ids, depth - 1), ")"]
    return [*grown(rng, ids, depth - 1), rng.choice(["AND", "OR"]), *grown(rng, ids, depth - 1)]


def test_null_ids_repeats_and_clashing_names(documents):
    docs = documents((None, "MIT License"), (4, "x"), (4, "x")).withColumns({"labels": F.lit(1), "score": F.lit("s"), "permitted": F.lit(0)})
    got = sorted((r.doc_id or 0, r.labels, r.permitted) for r in ls.scan_licenses(docs).collect())
    assert got == [(0, "mit", None), (4, "", None), (4, "", None)]
