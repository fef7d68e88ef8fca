"""Packing of whole documents into training sequences by the online sum-of-squares rule.

Every document is its ids and an end id. Its leading full windows are sequences of their own; the rest is placed at
once, into the fill level for which the sum of squares of the numbers of partly filled windows per level grows least.
The numbers stand in a level array, so a choice costs one pass over ``window`` integers, however many windows are
open. Of equal levels the fullest is taken.

A task packs the documents of its own split and moves no row. It keeps at most ``OPEN`` windows open; beyond that,
and at its end, it settles: what the emptiest windows hold is cut to fill up the fullest. The last window of a task
is dealt out by the binary digits of its fill, since a sequence of a power of two needs no padding. So nothing is
padded at all, and only documents in settled windows are cut beyond their full windows.

Ids come from the tokenizers library with the caller's vocabulary file, read by the driver and sent as it is. Texts
of Latin letters are cut at blanks by Arrow, up to ``LOOKUP_BYTES`` of them at a time. What stands between blanks is cut
into words by the vocabulary's own rules, once for all texts of that lot; a word's ids are asked for when it is first
seen and kept for later lots and for later tasks of the same worker process. Other texts are encoded whole. Both give
the library's ids (tested).

Defined cases: a null or empty text is the end id alone. Rows that repeat an id or a text are documents of their own.
Documents of any length are cut, never shortened. An empty table has no pieces. Only ``doc_id`` and ``text`` are
read. ``sequence_id`` holds the task's number in its upper bits: it is unique, not gapless, and the same for the same
splits.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from logilake.llm.bpe import byte_letters, vocabulary
from logilake.llm.common import query, table

WINDOW = 4096
END = 2
OPEN = 1024
TASK_BITS = 40
ID_BYTES = 4  # ids are little-endian unsigned 32-bit numbers

KNOWN_WORDS, KNOWN_LENGTH = 500_000, 48
LOOKUP_BYTES = 12 << 20

# Fixed value: the vocabulary's words for texts whose characters are all below U+0250, after lower-casing (which gives
# some letters beyond).
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u02af\u2c65\u2c66"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACES = "\t-\r \x85\xa0"
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+").findall
# What the word rules do not cover: other scripts, the one letter whose lower case is two characters, special strings,
# and the four characters that Arrow takes for blanks and the vocabulary does not.
_OTHER = re.compile("[^\x00-\u012f\u0131-\u024f]").search
_BLANKS = "\x1c\x1d\x1e\x1f"
# The vocabulary's letter for each byte; those of printable ASCII are its own.
_LETTER_OF = dict(enumerate(byte_letters()))


def _is_other(text: str) -> bool:
    return "<|" in text or any(c in text for c in _BLANKS) or not text.isascii() and _OTHER(text) is not None


def word_vocabulary(path: str) -> str:
    return vocabulary(path)


class _Known(dict):
    """Word -> its ids as bytes, asked for at first sight; a run of several words is put together and not kept. A full
    table becomes ``older``, from which words that come again are taken back, so frequent words stay."""

    def __init__(self, model):
        self.model, self.older = model, {}

    def __missing__(self, run: str) -> bytes:
        ids = self.older.get(run)
        if ids is None:
            words = _WORDS(run)
            if len(words) != 1:
                return b"".join(map(self.__getitem__, words))
            letters = run if run.isascii() and run.isprintable() else run.encode().decode("latin-1").translate(_LETTER_OF)
            ids = _as_bytes([t.id for t in self.model.tokenize(letters)])
        if len(run) <= KNOWN_LENGTH:
            self.age()
            self[run] = ids
        return ids

    def age(self) -> None:
        if len(self) >= KNOWN_WORDS:
            self.older = dict(self)
            self.clear()


def _as_bytes(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


class Words:
    """Ids of texts as bytes, by the library, with a table of known words that is bounded in entries and in bytes."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known = _Known(self.tokenizer.model)

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Ids of each text, one after the other."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        self.known.age()
        whole = {at: self._whole(t) for at, t in enumerate(texts.to_pylist()) if t and _is_other(t)}
        if whole:
            texts = pc.if_else(pa.array([at in whole for at in range(len(texts))]), pa.scalar(None, texts.type), texts)
        cut = self._cut(texts)
        return [whole.get(at, ids) for at, ids in enumerate(cut)] if whole else cut

    def _cut(self, texts: pa.Array) -> list[bytes]:
        """Ids by words. What stands between blanks, where no word reaches across, is looked up once for all texts."""
        runs = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
        distinct = runs.values.dictionary_encode()
        of_run = list(map(self.known.__getitem__, distinct.dictionary.to_numpy(zero_copy_only=False).tolist()))
        ids, sizes = np.frombuffer(b"".join(of_run), "<u4"), np.fromiter(map(len, of_run), np.int64, len(of_run)) // ID_BYTES
        run = distinct.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[run])])
        shift = ((np.cumsum(sizes) - sizes)[run] - ends[:-1]).astype(np.int32)  # ids are fewer than an Arrow array's bytes
        found = ids[np.repeat(shift, sizes[run]) + np.arange(ends[-1], dtype=np.int32)].tobytes()
        edges = (ID_BYTES * ends[runs.offsets.to_numpy()]).tolist()
        return [found[a:b] for a, b in zip(edges, edges[1:])]

    def _whole(self, text: str) -> bytes:
        return _as_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)


def _shared_words(shared: dict) -> Words:
    if "words" not in shared:
        shared["words"] = Words(shared["vocabulary"])
    return shared["words"]


class Piece(NamedTuple):
    doc: int | None
    start: int
    ids: bytes
    doc_tokens: int

    @property
    def size(self) -> int:
        return len(self.ids) // ID_BYTES

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[: at * ID_BYTES]), self._replace(ids=self.ids[at * ID_BYTES :], start=self.start + at)


class Packer:
    """Windows of one task. Finished sequences, lists of pieces, are in ``done`` for the caller to take."""

    def __init__(self, window: int = WINDOW, open_windows: int = OPEN):
        self.window, self.most = window, open_windows
        self.levels = np.zeros(window + 1, np.int64)  # windows that are filled so far
        self.at_level: dict[int, list[list[Piece]]] = {}
        self.open = 0
        self.done: list[list[Piece]] = []

    def level_for(self, size: int) -> int:
        """The fill level to place a piece at; 0 is a new window. Leaving level h and reaching h + size changes the
        sum of squares by 2 (levels[h + size] - levels[h]) + 2, without the terms of an empty and a full window."""
        last = self.window - size
        change = 2 * self.levels[size:] + 1
        change[last] = 0
        held = self.levels[1 : last + 1]
        change[1:] += np.where(held > 0, 1 - 2 * held, np.iinfo(np.int64).max // 2)
        return last - int(change[::-1].argmin())

    def add(self, doc: int | None, ids: bytes) -> None:
        """Place a document, whose ids end with its end id."""
        piece = Piece(doc, 0, ids, len(ids) // ID_BYTES)
        while piece.size >= self.window:
            full, piece = piece.cut(self.window)
            self.done.append([full])
        if piece.size:
            level = self.level_for(piece.size)
            self._fill(self._take(level), level, piece)
        if self.open > self.most:
            self.settle()

    def _take(self, level: int) -> list[Piece]:
        if not level:
            return []
        self.levels[level] -= 1
        self.open -= 1
        return self.at_level[level].pop()

    def _fill(self, held: list[Piece], level: int, piece: Piece) -> None:
        held.append(piece)
        level += piece.size
        if level == self.window:
            self.done.append(held)
            return
        self.levels[level] += 1
        self.open += 1
        self.at_level.setdefault(level, []).append(held)

    def settle(self) -> None:
        """Fill the fullest windows with what the emptiest hold; one partly filled window stays."""
        filled = [(level, held) for level in sorted(self.at_level) for held in self.at_level[level]]
        self.levels[:] = 0
        self.at_level.clear()
        self.open = 0
        first, (level, held) = 0, filled.pop() if filled else (0, [])
        while first < len(filled):
            giver = filled[first][1]
            piece = giver.pop()
            room = self.window - level
            if piece.size > room:
                rest, piece = piece.cut(piece.size - room)
                giver.append(rest)
            held.append(piece)
            level += piece.size
            if not giver:
                first += 1
            if level == self.window:
                self.done.append(held)
                # The emptiest may be the one that was just taken from, so it is measured anew.
                level, held = (0, []) if first >= len(filled) else filled.pop()
                level = sum(p.size for p in held)
        if held:
            self.levels[level] = 1
            self.open = 1
            self.at_level[level] = [held]

    def finish(self) -> None:
        """Settle, and deal the last window out by powers of two."""
        self.settle()
        rest = [p for windows in self.at_level.values() for held in windows for p in held][::-1]
        self.levels[:], self.open, self.at_level = 0, 0, {}
        total = sum(p.size for p in rest)
        while total:
            room = 1 << (total.bit_length() - 1)
            total -= room
            held = []
            while room:
                piece = rest.pop()
                if piece.size > room:
                    piece, left = piece.cut(room)
                    rest.append(left)
                held.append(piece)
                room -= piece.size
            self.done.append(held)


def _rows(done: list[list[Piece]], first: int, kind: pa.DataType, with_ids: bool) -> pa.RecordBatch:
    pieces = [(p, first + k, offset) for k, held in enumerate(done) for p, offset in _offsets(held)]
    columns = {
        "doc_id": pa.array([p.doc for p, _, _ in pieces], kind),
        "start": pa.array([p.start for p, _, _ in pieces], pa.int64()),
        "length": pa.array([p.size for p, _, _ in pieces], pa.int64()),
        "ids_crc32": pa.array([zlib.crc32(p.ids) for p, _, _ in pieces], pa.int64()),
        "doc_tokens": pa.array([p.doc_tokens for p, _, _ in pieces], pa.int64()),
        "sequence_id": pa.array([s for _, s, _ in pieces], pa.int64()),
        "offset": pa.array([o for _, _, o in pieces], pa.int64()),
    }
    if with_ids:
        columns["ids"] = pa.array([np.frombuffer(p.ids, "<u4").astype(np.int32) for p, _, _ in pieces], pa.list_(pa.int32()))
    return pa.RecordBatch.from_pydict(columns)


def _offsets(held: list[Piece]) -> Iterator[tuple[Piece, int]]:
    at = 0
    for piece in held:
        yield piece, at
        at += piece.size


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined to at most ``LOOKUP_BYTES``, since a run is looked up once in each; a larger batch stays as it is."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > LOOKUP_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def pack(
    docs: DataFrame, path: str, window: int = WINDOW, end: int = END, with_ids: bool = False, open_windows: int = OPEN
) -> DataFrame:
    """One row per piece: its document, place there, digest, sequence and place there, and on demand its ids."""
    # A worker process holds one copy of what is sent, so its tasks share the words that they learn.
    shared = docs.sparkSession.sparkContext.broadcast({"vocabulary": word_vocabulary(path)})
    end_bytes = end.to_bytes(ID_BYTES, "little")

    def run(batches):
        words, packer = _shared_words(shared.value), Packer(window, open_windows)
        sequence = TaskContext.get().partitionId() << TASK_BITS
        kind = None
        for batch in _together(batches):
            kind = batch.schema.field(0).type
            encoded = words.encode(batch.column(1))
            for doc, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                packer.add(doc, ids + end_bytes)
            if packer.done:
                yield _rows(packer.done, sequence, kind, with_ids)
                sequence += len(packer.done)
                packer.done.clear()
        if kind is not None:
            packer.finish()
            yield _rows(packer.done, sequence, kind, with_ids)

    columns = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, {columns}")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op12_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return pack(table(spark, sf_dir, "documents"), default_path())
