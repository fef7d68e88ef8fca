"""Benchmark decontamination: a BM25 inverted index of the test items, searched by block-max WAND.

Every training passage is a query. A passage is a window of words, twice as long as the longest test item of a length
class (up to 64 words, 256, 1024, ...), and windows overlap by half, so an item of the class that stands in a document
lies whole in one of its windows.

* Numbers of items and words, item frequencies of words and the longest item of a class are those of the whole test set,
  so what is found of an item does not depend on the part it is in.

* An item's BM25 impacts are divided by their sum, so an item that contains itself scores 1.
* Items lie in blocks of ``BLOCK_ITEMS``. Per term and block the index holds the largest impact. The sum of these
  over a passage bounds the score of every item of the block; blocks below the threshold are skipped. These bounds
  are computed for all passages and blocks at once.
* In the remaining blocks, WAND walks the posting lists item by item: cursors in item order, a pivot where the sum of
  the block's term maxima reaches the threshold, and a full score only if all cursors before it stand there too.
* All items at or above ``THRESHOLD`` are retrieved, without a limit. One is a hit if the passage also holds at least
  ``OVERLAP`` of the word triples of its question and of its answer.

Question and answer: up to the last question mark, and the rest; without one, the sentences nearest to half of the
words; an item of one sentence is its own question and answer.

The index is sent to executors. It is built from parts of at most ``PART_ITEMS`` items of a class and ``PART_BYTES`` of
text, or a single longer item. Larger test sets are searched in rounds, one pass over the documents each, of about
``PARTS`` such parts in number of items and bytes; items are dealt to rounds by hash.

Defined cases: null and empty texts hold nothing, and items without words are found nowhere. Items without an id are
searched like others and give hits with a null id. Repeated items are separate hits, repeated documents are separate rows. Case and ASCII punctuation do not matter. Documents are read
whole. Only ``doc_id`` and ``text`` are needed; the filter keeps all columns.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logilake.llm.common import query, staged, table

THRESHOLD = 0.6
OVERLAP = 0.5
K1, B = 1.2, 0.75
BLOCK_ITEMS = 8
PART_ITEMS = 1024
PART_BYTES = 512 << 10
PARTS = 16
SHORT, LONGER = 64, 4  # words of the items of the first length class, and how many times more the next has
CHUNK = 50_000  # hits whose bounds are computed at once

_FOLD = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_FOLD).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    if "?" in text:
        cut = text.rindex("?") + 1
        parts = words_of(text[:cut]), words_of(text[cut:])
    else:
        sentences = [w for w in map(words_of, _SENTENCE.findall(text)) if w]
        half = sum(map(len, sentences)) / 2
        cuts = range(1, len(sentences))
        cut = min(cuts, key=lambda i: abs(sum(map(len, sentences[:i])) - half), default=0)
        parts = [w for s in sentences[:cut] for w in s], [w for s in sentences[cut:] for w in s]
    if not parts[0] or not parts[1]:
        whole = parts[0] or parts[1]
        return whole, whole
    return parts


def _grams(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    return set(zip(*(words[i:] for i in range(n)), strict=False))


def length_class(words: int) -> int:
    found, most = 0, SHORT
    while words > most:
        found, most = found + 1, most * LONGER
    return found


class Statistics(NamedTuple):
    """Of the whole test set."""

    items: int
    words: int
    longest: int  # words of the longest item of the part's length class
    frequency: dict[bytes, int]  # items that have a word; at least for the part's words


class Hit(NamedTuple):
    item_id: int | None
    score: float
    question_overlap: float
    answer_overlap: float


class Index:
    """Of one part of the items, given as (item_id, text), which is all of them without ``whole``."""

    def __init__(self, items: list[tuple[int | None, str]], whole: Statistics | None = None):
        items = [(i, t, w) for i, t in items if (w := words_of(t))]
        self.ids = [i for i, _, _ in items]
        self.parts = [question_and_answer(t) for _, t, _ in items]
        counts = [Counter(w) for _, _, w in items]
        lengths = [len(w) for _, _, w in items]
        own = Counter(t for c in counts for t in c)
        whole = whole or Statistics(len(items), sum(lengths), max(lengths, default=1), own)
        self.longest = whole.longest
        mean = whole.words / max(1, whole.items)
        self.terms = {t: k for k, t in enumerate(own)}
        self.term_of = self.terms.get
        frequency = {t: whole.frequency[t] for t in own}
        idf = {t: math.log(1 + (whole.items - n + 0.5) / (n + 0.5)) for t, n in frequency.items()}
        # Postings of a term: (item, impact), in item order.
        self.postings: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for item, (c, length) in enumerate(zip(counts, lengths, strict=True)):
            norm = K1 * (1 - B + B * length / mean)
            impacts = {t: idf[t] * n * (K1 + 1) / (n + norm) for t, n in c.items()}
            total = sum(impacts.values())
            for t, impact in impacts.items():
                self.postings[self.terms[t]].append((item, impact / total))
        blocks = -(-len(items) // BLOCK_ITEMS)
        # The last row stands for words that are in no item.
        self.block_max = np.zeros((len(self.terms) + 1, max(1, blocks)), np.float32)
        for k, found in enumerate(self.postings):
            for item, impact in found:
                at = item // BLOCK_ITEMS
                self.block_max[k, at] = max(self.block_max[k, at], impact)

    def bounds(self, terms: np.ndarray, windows: np.ndarray, count: int) -> np.ndarray:
        """Sum of block maxima per window (rows) and block, for the terms of windows in order."""
        out = np.zeros((count, self.block_max.shape[1]), np.float32)
        for start in range(0, len(terms), CHUNK):
            own = windows[start : start + CHUNK]
            firsts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            out[own[firsts]] += np.add.reduceat(self.block_max[terms[start : start + CHUNK]], firsts)
        return out

    def wand(self, terms: list[int], block: int, threshold: float) -> list[tuple[int, float]]:
        """All items of a block whose score for a passage's terms reaches the threshold."""
        low, high = block * BLOCK_ITEMS, (block + 1) * BLOCK_ITEMS
        lists = []
        for t in terms:
            own = [p for p in self.postings[t] if low <= p[0] < high]
            if own:
                lists.append((float(self.block_max[t, block]), own))
        cursors = [[own[0][0], bound, 0, own] for bound, own in lists]
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            reach, pivot = 0.0, None
            for c in cursors:
                reach += c[1]
                if reach >= threshold:
                    pivot = c[0]
                    break
            if pivot is None:
                break
            if cursors[0][0] == pivot:
                score = sum(c[3][c[2]][1] for c in cursors if c[0] == pivot)
                if score >= threshold:
                    found.append((pivot, score))
                target = pivot + 1
            else:
                target = pivot
            for c in cursors:
                while c[2] < len(c[3]) and c[3][c[2]][0] < target:
                    c[2] += 1
                c[0] = c[3][c[2]][0] if c[2] < len(c[3]) else high
            cursors = [c for c in cursors if c[0] < high]
        return found

    def verify(self, item: int, passage: list[bytes]) -> tuple[float, float]:
        """Shares of the word triples of question and answer that the passage holds."""
        shares = []
        for part in self.parts[item]:
            n = min(3, len(part))
            grams = _grams(part, n)
            shares.append(len(grams & _grams(passage, n)) / len(grams))
        return shares[0], shares[1]

    def search(self, texts: list[list[bytes]], threshold: float = THRESHOLD, overlap: float = OVERLAP) -> list[list[Hit]]:
        """Hits of each text, given as its words; each item at most once, at its best passage."""
        hits: list[dict[int, Hit]] = [{} for _ in texts]
        if not self.ids:
            return [[] for _ in texts]
        stride = self.longest
        none = len(self.terms)
        width = none + 1
        owners, starts, pairs, base = [], [], [], 0
        for text, words in enumerate(texts):
            terms = np.array(list(map(self.term_of, words, repeat(none))), np.int64)
            places = np.flatnonzero(terms != none)
            terms = terms[places]
            # Window k holds segments k and k + 1: each word lies in its own segment's window and the one before.
            count = max(1, -(-len(words) // stride) - 1)
            segment = places // stride
            own, before = segment < count, segment > 0
            pairs.append((segment[own] + base) * width + terms[own])
            pairs.append((segment[before] - 1 + base) * width + terms[before])
            owners += [text] * count
            starts += range(0, count * stride, stride)
            base += count
        # A passage's terms count once.
        distinct = np.unique(np.concatenate(pairs))
        window_of, terms = distinct // width, distinct % width
        bounds = self.bounds(terms, window_of, base)
        begins = np.searchsorted(window_of, np.arange(base + 1))
        for window, block in np.argwhere(bounds >= threshold * 0.9999).tolist():
            text = owners[window]
            passage = texts[text][starts[window] : starts[window] + 2 * stride]
            own = terms[begins[window] : begins[window + 1]]
            own = own[self.block_max[own, block] > 0]
            for item, score in self.wand(own.tolist(), block, threshold):
                question, answer = self.verify(item, passage)
                if question >= overlap and answer >= overlap:
                    best = hits[text].get(item)
                    if best is None or (score, question + answer) > (best.score, best.question_overlap + best.answer_overlap):
                        hits[text][item] = Hit(self.ids[item], score, question, answer)
        return [list(h.values()) for h in hits]


class Part(NamedTuple):
    items: list[tuple[int | None, str]]
    whole: Statistics

    def index(self) -> Index:
        return Index(*self)


def _counted(benchmark: DataFrame) -> DataFrame:
    """item_id, text, words, bytes and distinct terms of every item that has words."""

    def run(batches):
        for batch in batches:
            words = [words_of(t) for t in batch.column(1).to_pylist()]
            terms = [sorted(set(w)) for w in words]
            sizes = [pa.array(map(len, words), pa.int64()), pa.array((sum(map(len, w)) for w in words), pa.int64())]
            classes = pa.array([length_class(len(w)) for w in words], pa.int32())
            found = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *sizes, classes, pa.array(terms, pa.list_(pa.binary()))],
                ["item_id", "text", "words", "bytes", "kind", "terms"],
            )
            yield found.filter(pa.array([bool(w) for w in words], pa.bool_()))

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return rows.mapInArrow(run, "item_id long, text string, words long, bytes long, kind int, terms array<binary>")


def _rounds(benchmark: DataFrame) -> Iterator[list[Part]]:
    """Parts of the items by round, with the whole test set's statistics of their words; two collects each."""
    items = staged(_counted(benchmark).withColumn("number", F.monotonically_increasing_id()), "test-items")
    by_kind = items.groupBy("kind").agg(
        F.count(F.lit(1)).alias("items"), F.sum("words").alias("words"), F.sum("bytes").alias("bytes"), F.max("words").alias("longest")
    )
    kinds = {r.kind: r for r in by_kind.collect()}
    count, words, size = (sum(r[c] for r in kinds.values()) for c in ("items", "words", "bytes"))
    if not count:
        yield []
        return
    rounds = max(-(-count // (PARTS * PART_ITEMS)), -(-size // (PARTS * PART_BYTES)))
    items = items.withColumn("round", F.pmod(F.xxhash64("number"), F.lit(rounds)))
    terms = items.select("round", F.explode("terms").alias("term"))
    # The whole set's counts; a round fetches those of its own words.
    frequency = staged(terms.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "test-words")
    for k in range(rounds):
        rows = items.where(F.col("round") == k).select("kind", "item_id", "text", "bytes").collect()
        own = terms.where(F.col("round") == k).select("term").distinct()
        n = {bytes(r.term): r.n for r in own.join(frequency, "term").collect()}
        parts: list[list] = []
        for row in sorted(rows, key=lambda r: (r.kind, r.item_id is None, r.item_id or 0, r.text)):
            if not parts or parts[-1][0].kind != row.kind or len(parts[-1]) >= PART_ITEMS or room < row.bytes:
                parts.append([])
                room = PART_BYTES
            parts[-1].append(row)
            room -= row.bytes
        found = []
        for part in parts:
            texts = [(r.item_id, r.text) for r in part]
            used = {t for _, text in texts for t in words_of(text)}
            found.append(Part(texts, Statistics(count, words, kinds[part[0].kind].longest, {t: n[t] for t in used})))
        yield found


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row (doc_id, item_id, score, question_overlap, answer_overlap) per test item that stands in a document."""

    def searched(parts):
        def run(batches):
            indexes = [p.index() for p in parts]
            for batch in batches:
                texts = [words_of(t) for t in batch.column(1).to_pylist()]
                for index in indexes:
                    found = index.search(texts)
                    owners = [i for i, h in enumerate(found) for _ in h]
                    flat = [h for own in found for h in own]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(owners, pa.int64())),
                            pa.array([h.item_id for h in flat], pa.int64()),
                            *(pa.array([h[k] for h in flat], pa.float64()) for k in (1, 2, 3)),
                        ],
                        ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
                    )

        return run

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, item_id long, score double, question_overlap double, answer_overlap double"
    rows = docs.select("doc_id", "text")
    out = None
    for parts in _rounds(benchmark):
        found = rows.mapInArrow(searched(parts), schema)
        out = found if out is None else out.unionByName(found)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no test item, all their columns as they were. Nothing is shuffled."""
    text_at = docs.columns.index("text")

    def without(parts):
        def run(batches):
            indexes = [p.index() for p in parts]
            for batch in batches:
                texts = [words_of(t) for t in batch.column(text_at).to_pylist()]
                found = [index.search(texts) for index in indexes]
                yield batch.filter(pa.array([not any(f[i] for f in found) for i in range(len(texts))], pa.bool_()))

        return run

    for parts in _rounds(benchmark):
        docs = docs.mapInArrow(without(parts), docs.schema)
    return docs


@query("op9_decontaminate")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, with the item."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
