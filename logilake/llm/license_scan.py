"""Licence scan: an Aho-Corasick automaton finds notice phrases and identifier tags, a shunting-yard parser
evaluates the expressions behind the tags.

Words are runs of letters, digits and characters beyond ASCII, after lower-casing A-Z. The automaton runs over the
words joined by single spaces, so a phrase matches wherever its words stand consecutively. Overlapping and repeated
places all count.

* Base phrases give base labels (``BASE_PHRASES``).
* Further notice phrases give labels of their own (``NOTICE_PHRASES``).
* ``SPDX-License-Identifier:`` tags are followed by an expression of ids, ``AND``, ``OR``, ``WITH`` and brackets; the
  operators count in capitals only, words after a complete expression are prose. Its known operands become labels in
  lower case; an exception becomes ``<licence> with <exception>``. Of an ``OR`` all alternatives are labels, since
  each is a licence that the text offers. Ids that are not known give no label. A broken expression counts as absent.
* Each expression is evaluated under a set of licences that a user permits (``PERMITTED``, ``PERMITTED_WITH``): an
  ``OR`` needs one permitted side, an ``AND`` both, a ``WITH`` the pair or the licence alone. ``permitted`` says
  whether all the text's expressions hold; null without an expression.

Score, the confidence that the text carries a licence: ``1 - product(1 - weight)`` over the distinct labels, with
1.0 for a tag whose ids are all known, 0.7 for one with others, 0.9 for a base phrase and 0.6 for another notice; 0
without any label.

Defined cases: a null text is empty: no words, empty labels, null places, score 0, permitted null. A null ``doc_id`` is
kept. Whole texts are scanned. Rows that repeat are answered alike. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from logilake.llm.common import query, table

# Phrases of the contract and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
NOTICE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl-1.0",
    "isc license": "isc",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
    "apache license version 2 0": "apache-2.0",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
}
# Licence ids of the public list that texts use most, in lower case; a "+" may follow, and ids of a
# text's own start with "licenseref-".
LICENSE_IDS = frozenset(
    "0bsd afl-1.1 afl-2.0 afl-2.1 afl-3.0 agpl-1.0-only agpl-1.0-or-later agpl-3.0 agpl-3.0-only agpl-3.0-or-later "
    "apache-1.0 apache-1.1 apache-2.0 apsl-2.0 artistic-1.0 artistic-1.0-perl artistic-2.0 blueoak-1.0.0 bsd-1-clause "
    "bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause bsl-1.0 busl-1.1 bzip2-1.0.6 "
    "cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-2.0 cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-nd-3.0 "
    "cc-by-nc-nd-4.0 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 cc-by-nd-3.0 cc-by-nd-4.0 cc-by-sa-2.0 cc-by-sa-2.5 cc-by-sa-3.0 "
    "cc-by-sa-4.0 cc-pddc cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cecill-b cecill-c cpl-1.0 curl ecl-2.0 elastic-2.0 "
    "epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 fsfap ftl gfdl-1.1-only gfdl-1.2-only gfdl-1.3-only gfdl-1.3-or-later gpl-1.0-only "
    "gpl-1.0-or-later gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0-only gpl-3.0-or-later hpnd icu ijg ipl-1.0 "
    "isc lgpl-2.0 lgpl-2.0-only lgpl-2.0-or-later lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only "
    "lgpl-3.0-or-later libpng libpng-2.0 libtiff lppl-1.3c mit mit-0 mit-cmu mpl-1.0 mpl-1.1 mpl-2.0 "
    "mpl-2.0-no-copyleft-exception ms-pl ms-rl mulanpsl-2.0 ncsa odbl-1.0 odc-by-1.0 ofl-1.0 ofl-1.1 openssl osl-2.1 osl-3.0 "
    "pddl-1.0 php-3.01 postgresql psf-2.0 python-2.0 qpl-1.0 ruby sissl sleepycat spl-1.0 sspl-1.0 tcl unicode-3.0 "
    "unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 xfree86-1.1 zlib zlib-acknowledgement zpl-2.0 zpl-2.1".split()
)
EXCEPTION_IDS = frozenset(
    "autoconf-exception-2.0 autoconf-exception-3.0 bison-exception-2.2 bootloader-exception classpath-exception-2.0 "
    "font-exception-2.0 gcc-exception-2.0 gcc-exception-3.1 libtool-exception linux-syscall-note llvm-exception "
    "ocaml-lgpl-linking-exception openssl-exception qt-gpl-exception-1.0 swift-exception wxwindows-exception-3.1".split()
)
# What a corpus may use without further conditions: licences, and copyleft ones by their exception.
PERMITTED = frozenset(
    "0bsd apache-2.0 blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-3-clause bsl-1.0 cc-by-3.0 cc-by-4.0 cc-pddc cc0-1.0 isc "
    "mit mit-0 ncsa odc-by-1.0 pddl-1.0 postgresql psf-2.0 unlicense upl-1.0 x11 zlib".split()
)
PERMITTED_WITH = frozenset(
    {("gpl-2.0-only", "classpath-exception-2.0"), ("gpl-2.0-or-later", "classpath-exception-2.0"), ("gpl-3.0-or-later", "gcc-exception-3.1")}
)
TAG_WORDS = "spdx license identifier"
TAG_WEIGHT, PARTLY_WEIGHT, BASE_WEIGHT, NOTICE_WEIGHT = 1.0, 0.7, 0.9, 0.6

# A-Z to a-z, and every other ASCII character that is no letter or digit to a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_TAG = re.compile(r"SPDX-License-Identifier[ \t]*:[ \t]*([^\r\n]*)", re.IGNORECASE)
_OPERAND = re.compile(r"[A-Za-z0-9.+:-]+|[()]")
_PRECEDENCE = {"OR": 1, "AND": 2, "WITH": 3}


class Expression(NamedTuple):
    """A node: an operator with two sides, or an id without."""

    value: str
    left: Expression | None = None
    right: Expression | None = None

    @property
    def is_id(self) -> bool:
        return self.left is None or self.right is None

    def known(self) -> bool:
        """Whether all ids are known."""
        if self.is_id:
            return _is_license(self.value)
        if self.value == "WITH":
            return self.left.known() and self.right.value.lower() in EXCEPTION_IDS
        return self.left.known() and self.right.known()

    def labels(self) -> set[str]:
        if self.is_id:
            return {self.value.lower()} if _is_license(self.value) else set()
        if self.value == "WITH":
            exception = self.right.value.lower()
            return {f"{x} with {exception}" if exception in EXCEPTION_IDS else x for x in self.left.labels()}
        return self.left.labels() | self.right.labels()

    def permitted(self, licenses: frozenset[str] = PERMITTED, pairs: frozenset[tuple[str, str]] = PERMITTED_WITH) -> bool:
        """Whether the licences allow it: one side of an OR, both of an AND, the pair or the licence of a WITH."""
        if self.is_id:
            return self.value.lower() in licenses
        left = self.left.permitted(licenses, pairs)
        if self.value == "WITH":
            return left or (self.left.value.lower(), self.right.value.lower()) in pairs
        right = self.right.permitted(licenses, pairs)
        return left or right if self.value == "OR" else left and right


def _is_license(value: str) -> bool:
    low = value.lower()
    return low in LICENSE_IDS or low.removesuffix("+") in LICENSE_IDS or low.startswith("licenseref-")


def parse_expression(text: str) -> Expression | None:
    """The longest well-formed expression at the start of a line, by shunting yard; None if there is none."""
    output: list[Expression] = []
    operators: list[str] = []
    expect_operand = True

    def reduce_top() -> None:
        right, left = output.pop(), output.pop()
        output.append(Expression(operators.pop(), left, right))

    at = 0
    while True:
        while at < len(text) and text[at] in " \t":
            at += 1
        token = _OPERAND.match(text, at)
        if token is None:
            break
        word = token.group().rstrip(".:") or token.group()
        if expect_operand:
            if word == "(":
                operators.append(word)
            elif word == ")" or word in _PRECEDENCE:
                return None
            else:
                output.append(Expression(word))
                expect_operand = False
        elif word == ")":
            while operators and operators[-1] != "(":
                reduce_top()
            if not operators:
                return None
            operators.pop()
        elif word in _PRECEDENCE:
            rank = _PRECEDENCE[word]
            while operators and operators[-1] != "(" and _PRECEDENCE[operators[-1]] >= rank:
                reduce_top()
            operators.append(word)
            expect_operand = True
        else:
            break  # prose after a complete expression
        at = token.end()
    if expect_operand or "(" in operators:
        return None
    while operators:
        reduce_top()
    return output[0]


def _valid(node: Expression) -> bool:
    """WITH joins a plain licence to a plain exception."""
    if node.left is None or node.right is None:
        return True
    if node.value == "WITH":
        return node.left.left is None and node.right.left is None
    return _valid(node.left) and _valid(node.right)


def expressions(text: str) -> list[Expression]:
    """The well-formed expressions of a text's tags."""
    nodes = (parse_expression(tag.group(1)) for tag in _TAG.finditer(text))
    return [node for node in nodes if node is not None and _valid(node)]


def tag_labels(text: str) -> set[str]:
    return set().union(*(node.labels() for node in expressions(text)))


class Scan(NamedTuple):
    n_words: int
    n_base: int
    first_word: int | None
    last_word: int | None
    base_labels: str
    labels: str
    score: float
    permitted: bool | None


class Scanner:
    def __init__(self) -> None:
        # Each phrase between spaces: (label, is base, words); the tag has no label.
        self.automaton = ahocorasick.Automaton()
        entries = [(p, label, True) for p, label in BASE_PHRASES.items()]
        entries += [(p, label, False) for p, label in NOTICE_PHRASES.items()]
        for phrase, label, base in [*entries, (TAG_WORDS, None, False)]:
            self.automaton.add_word(f" {phrase} ", (label, base, len(phrase) + 1))
        self.automaton.make_automaton()

    def scan(self, text: str | None) -> Scan:
        text = text or ""
        words = text.encode().translate(_FOLD).split(b" ")
        words = [w for w in words if w]
        joined = " " + b" ".join(words).decode() + " "
        base: set[str] = set()
        notices: set[str] = set()
        n_base, tagged, first, last = 0, False, None, None
        counted, word = 0, 0  # spaces before ``counted`` are words passed
        for end, (label, is_base, length) in sorted(self.automaton.iter(joined), key=lambda m: m[0] - m[1][2]):
            if label is None:
                tagged = True
            elif is_base:
                start = end - length
                word += joined.count(" ", counted, start)
                counted = start
                n_base += 1
                first = word if first is None else first
                last = word
                base.add(label)
            else:
                notices.add(label)
        weights = dict.fromkeys(notices, NOTICE_WEIGHT) | dict.fromkeys(base, BASE_WEIGHT)
        found = expressions(text) if tagged else []
        for node in found:
            weight = TAG_WEIGHT if node.known() else PARTLY_WEIGHT
            for label in node.labels():
                weights[label] = max(weight, weights.get(label, 0))
        doubt = 1.0
        for weight in weights.values():
            doubt *= 1 - weight
        permitted = all(node.permitted() for node in found) if found else None
        labels = ",".join(sorted(weights))
        return Scan(len(words), n_base, first, last, ",".join(sorted(base)), labels, 1 - doubt, permitted)


SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, permitted boolean"
_TYPES = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.bool_()]


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: its licence labels, where the base phrases stand, and a score."""

    def run(batches):
        scanner = Scanner()
        for batch in batches:
            found = [scanner.scan(t) for t in batch.column(1).to_pylist()]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(_TYPES)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *Scan._fields])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


@query("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels of every document."""
    return scan_licenses(table(spark, sf_dir, "documents"))
