import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logilake.llm import packing


LIBRARY = Tokenizer.from_file(packing.default_path())


def library_ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, packing.END]


def check(docs, pieces, window, padding=0):
    """Each id in one piece, sequences gapless and no longer than a window, full or of a power of two."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        assert p.length == len(p.ids) and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(docs)
    for doc, text in docs.items():
        own = sorted(by_doc[doc], key=lambda p: p.start)
        ids = library_ids(text)
        assert sum((p.ids for p in own), []) == ids
        assert [p.start for p in own] == list(np.cumsum([0] + [p.length for p in own])[:-1])
        assert {p.doc_tokens for p in own} == {len(ids)}
    waste = 0
    for held in by_sequence.values():
        held.sort(key=lambda p: p.offset)
        assert [p.offset for p in held] == list(np.cumsum([0] + [p.length for p in held])[:-1])
        total = sum(p.length for p in held)
        assert 0 < total <= window
        waste += 0 if total & (total - 1) == 0 else window - total
    assert waste <= padding


def texts(n, seed=1):
    rng = random.Random(seed)
    words = ["alpha", "Beta's", "x1y22", "don't", "É", "ß?!", "İstanbul", "Ωσς ΣΑΣ", "日本語", "á", "<|endoftext|>", "\x85", "'s's", "--", " "]
    return [" ".join(rng.choice(words) + rng.choice(["", str(rng.randrange(99))]) for _ in range(int(rng.paretovariate(0.6)) % 900)) for _ in range(n)]


@pytest.mark.parametrize(("window", "open_windows"), [(64, 1024), (64, 3), (4096, 1024), (1, 5)])
def test_pieces_and_windows(spark, window, open_windows):
    docs = dict(enumerate(texts(60 if window > 1 else 8)))
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    pieces = packing.pack(frame, packing.default_path(), window, with_ids=True, open_windows=open_windows).collect()
    check(docs, pieces, window)


def test_ids_are_the_librarys():
    with open(packing.default_path(), encoding="utf-8") as file:
        words = packing.Words(file.read())
    batch = [*texts(300, 7), None, "", " ", "a" * 3000, "'" * 50 + "s", "".join(map(chr, range(1, 0x250)))]
    batch += [f"a{chr(c)}b {chr(c)}{chr(c)}1" for c in range(1, 0x260)]
    for text, ids in zip(batch, words.encode(batch), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library_ids(text)[:-1]
    assert all(len(w) <= packing.KNOWN_LENGTH for w in words.known)
    words.known.update({f"{i}": b"" for i in range(packing.KNOWN_WORDS + 1)})
    words.encode(["x"])
    assert len(words.known) < 10


def test_a_run_is_looked_up_once_for_many_texts():
    with open(packing.default_path(), encoding="utf-8") as file:
        words = packing.Words(file.read())
    asked = []

    class Counted(type(words.known)):
        def __missing__(self, run):
            asked.append(run)
            return super().__missing__(run)

    words.known = Counted(words.known.model)
    batch = ["One, two", None, "two one, \x1fthree", "one, TWO\x1cthree", "", "two\x85one,\xa0\x00three"] * 50
    for _ in range(2):
        for text, ids in zip(batch, words.encode(batch), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library_ids(text)[:-1]
    # The words of the texts without odd blanks; the runs of several words are put together once per call.
    assert sorted(asked) == sorted(["", "one,", "\x00three"] * 2 + ["one", ",", "two", "\x00", "three"])


def test_frequent_words_outlive_a_full_table(monkeypatch):
    with open(packing.default_path(), encoding="utf-8") as file:
        words = packing.Words(file.read())
    monkeypatch.setattr(packing, "KNOWN_WORDS", 5)
    words.encode(["a b c d e"])
    words.known["a"] = words.known.older["a"] = b"kept"
    assert words.encode(["f a"])[0].endswith(b"kept") and words.encode(["g h i a"])[0].endswith(b"kept")
    assert len(words.known) <= 5 and len(words.known.older) <= 5


def test_lots_keep_rows_and_their_order():
    sizes = (3, 4, packing.LOOKUP_BYTES, 0, 5)
    batches = [pa.record_batch({"doc_id": [2 * k, 2 * k + 1], "text": [None, "x" * size]}) for k, size in enumerate(sizes)]
    lots = list(packing._together(iter(batches)))
    assert [lot.column(0).to_pylist() for lot in lots] == [[0, 1, 2, 3], [4, 5], [6, 7, 8, 9]]
    assert list(packing._together(iter([]))) == []


def test_tasks_of_a_worker_share_what_they_learn():
    """What a worker process holds of a broadcast stays between its tasks."""
    shared = {"vocabulary": packing.word_vocabulary(packing.default_path())}
    first = packing._shared_words(shared)
    first.encode(["some words"])
    assert packing._shared_words(shared) is first and {"some", "words"} <= set(first.known)


def test_choice_is_the_one_of_the_rule():
    """The level array's choice against sums of squares that are counted anew."""
    rng = random.Random(3)
    packer = packing.Packer(window=20, open_windows=10**9)

    def squares(levels):
        return sum(n * n for h, n in enumerate(levels) if 0 < h < 20)

    for _ in range(400):
        size = rng.randrange(1, 20)
        options = {}
        for h in range(0, 20 - size + 1):
            levels = packer.levels.tolist()
            if h and not levels[h]:
                continue
            if h:
                levels[h] -= 1
            levels[h + size] += 1
            options[h] = squares(levels)
        least = min(options.values())
        assert packer.level_for(size) == max(h for h, s in options.items() if s == least)
        packer.add(None, bytes(4 * size))


def test_nulls_repeats_and_clashing_columns(spark, documents, write_tables):
    docs = documents((1, None), (None, "é"), (3, ""), (3, ""), (4, "x y " * 30_000)).withColumns({"length": F.lit(1), "offset": F.lit("z")})
    rows = packing.op12(spark, write_tables(documents=docs)).collect()
    tokens = {}
    for r in rows:
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
    assert tokens == {1: 1, None: 2, 3: 2, 4: 60_001}
    assert packing.pack(docs.limit(0), packing.default_path()).count() == 0
