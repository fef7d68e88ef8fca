"""Byte-level BPE: encoding with a queue of merge ranks, decoding by concatenating vocabulary strings.

A text is cut at the vocabulary's special strings and then into pre-tokens by the byte-level pattern. Each pre-token
is a doubly linked list of symbols with a priority queue of (rank, place) over neighbouring pairs. A popped entry is
stale, and skipped, if its symbols have meanwhile become part of others. Pre-tokens repeat, so a task keeps the ids
of those of at most ``CACHE_LENGTH`` characters in a table that is emptied when it reaches ``CACHE_ENTRIES``.

The vocabulary file is read by the driver, from a path that the caller names, and sent to executors as it is
(1.6 MB); it is never copied elsewhere.

Defined cases: a null or empty text has no tokens and decodes to the empty text. Bytes that are no UTF-8 decode to
the replacement character, as far as ids that someone else made can cause that. Very long texts and very long
pre-tokens need time n log n. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from logilake.llm.common import query, table

# Pre-tokens that a task keeps the ids of, and the characters that one may have; so the table is bounded in bytes.
CACHE_ENTRIES = 400_000
CACHE_LENGTH = 64

# Fixed value: the pattern of byte-level pre-tokens.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRE_TOKENS = regex.compile(PRE_TOKEN).findall

# The same pattern for texts without characters beyond U+024F, whose classes are short enough to be written out;
# the standard library's engine is then twice as fast.
LATIN = {
    r"\p{L}": "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f",
    r"\p{N}": "0-9\xb2\xb3\xb9\xbc-\xbe",
    r"\s": "\t-\r \x85\xa0",
}
LATIN_TOKENS = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{s}{L}{N}]+|[{s}]+(?![^{s}])|[{s}]+".format(
        L=LATIN[r"\p{L}"], N=LATIN[r"\p{N}"], s=LATIN[r"\s"]
    )
).findall
NOT_LATIN = re.compile("[^\x00-\u024f]").search


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class _Known(dict):
    """Pre-token -> ids, merged at first sight."""

    def __init__(self, merge):
        self.merge = merge

    def __missing__(self, token: str) -> tuple[int, ...]:
        ids = self.merge(token.encode())
        if len(token) <= CACHE_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[token] = ids
        return ids


class Bpe:
    """A tokenizer of one vocabulary file's content."""

    def __init__(self, content: str):
        file = json.loads(content)
        ids = file["model"]["vocab"]
        to_byte = {c: b for b, c in enumerate(byte_letters())}
        self.of_byte = [ids[c] for c in byte_letters()]
        # Pair of ids as one number -> rank; rank -> id of the merged symbol.
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(file["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[ids[left] << 32 | ids[right]] = rank
            self.merged.append(ids[left + right])
        self.strings = {i: bytes(to_byte[c] for c in s) for s, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.strings |= {i: s.encode() for s, i in self.special.items()}
        self.decimal = {i: str(i) for i in self.strings}
        ordered = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, ordered)) + ")") if ordered else None
        self.known = _Known(self.merge)

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one pre-token."""
        n = len(piece)
        of_byte, rank_of, merged_of = self.of_byte, self.ranks.get, self.merged
        symbols = [of_byte[b] for b in piece]
        # An entry is the rank and the place of the left symbol, as one number.
        queue = []
        for at in range(n - 1):
            rank = rank_of(symbols[at] << 32 | symbols[at + 1])
            if rank is not None:
                queue.append(rank << 32 | at)
        heapify(queue)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while queue:
            entry = heappop(queue)
            at, rank = entry & 0xFFFFFFFF, entry >> 32
            right = after[at]
            # Stale: the left symbol was absorbed (-1), or another pair stands there now.
            if right >= n or rank_of(symbols[at] << 32 | symbols[right]) != rank:
                continue
            symbols[at] = new = merged_of[rank]
            symbols[right] = -1
            after[at] = beyond = after[right]
            if beyond < n:
                before[beyond] = at
                rank = rank_of(new << 32 | symbols[beyond])
                if rank is not None:
                    heappush(queue, rank << 32 | at)
            left = before[at]
            if left >= 0:
                rank = rank_of(symbols[left] << 32 | new)
                if rank is not None:
                    heappush(queue, rank << 32 | left)
        return tuple([s for s in symbols if s >= 0])

    def _ids(self, text: str) -> Iterator[int]:
        tokens = LATIN_TOKENS(text) if NOT_LATIN(text) is None else PRE_TOKENS(text)
        return chain.from_iterable(map(self.known.__getitem__, tokens))

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.cut is None or self.cut.search(text) is None:
            return list(self._ids(text))
        out: list[int] = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(self.special[part])
            else:
                out.extend(self._ids(part))
        return out

    def joined(self, ids: Iterable[int]) -> str:
        """Decimal ids with commas between them."""
        return ",".join(map(self.decimal.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


def vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the ids of its whole text."""

    def run(batches, content):
        bpe = Bpe(content.value)
        for batch in batches:
            ids = pa.array([bpe.encode(t) for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return _with_vocabulary(docs.select("doc_id", "text"), run, "ids array<int>", path)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text that its ids stand for; null ids decode to the empty text."""

    def run(batches, content):
        bpe = Bpe(content.value)
        for batch in batches:
            texts = pa.array([bpe.decode(ids or ()) for ids in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["doc_id", "text"])

    return _with_vocabulary(encoded.select("doc_id", "ids"), run, "text string", path)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Per document the number of tokens and digests of its ids and of the text decoded from them."""

    def run(batches, content):
        bpe = Bpe(content.value)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for text in batch.column(1).to_pylist():
                ids = bpe.encode(text)
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(bpe.joined(ids).encode()).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _with_vocabulary(docs.select("doc_id", "text"), run, "n_tokens long, ids_sha256 string, decoded_sha256 string", path)


def _with_vocabulary(df: DataFrame, run, columns: str, path: str) -> DataFrame:
    content = df.sparkSession.sparkContext.broadcast(vocabulary(path))
    return df.mapInArrow(lambda batches: run(batches, content), f"doc_id {dict(df.dtypes)['doc_id']}, {columns}")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op7_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return round_trip(table(spark, sf_dir, "documents"), default_path())
