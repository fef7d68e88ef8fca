import random

import pytest
from tokenizers import Tokenizer

from logilake.llm import bpe

PATH = bpe.default_path()


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(bpe.vocabulary(PATH))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_random_texts_agree_with_the_library(own, library):
    rng = random.Random(1)
    pool = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "​", "　", "the", " of", "é", "ß", "'s", "'ll", "1", "²", "٣", "!", "😀", "中", "́", "_", "<|endoftext|>", "<|end"]
    pool += [chr(c) for c in range(0x250)]
    for _ in range(3000):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, repr(text)
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_pre_token(own, library):
    text = "ab" * 60_000 + " " + "é" * 5_000
    assert own.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert own.decode(own.encode(text)) == text


def test_ids_of_no_text_decode_to_replacement(own, library):
    ids = [own.of_byte[0xC3], own.of_byte[0x28]]
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_cache_is_bounded(library, monkeypatch):
    own = bpe.Bpe(bpe.vocabulary(PATH))
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    junk = ["".join(chr(97 + (i * j) % 26) for i in range(20_000)) for j in range(1, 6)]
    text = "one two three four five six one two " + " ".join(junk)
    assert own.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert 0 < len(own.known) <= 3 and max(map(len, own.known)) <= bpe.CACHE_LENGTH
    assert own.decode(own.encode(text)) == text


def test_documents_round_trip(spark, documents, tiny):
    docs = documents((1, None), (2, ""), (3, "Hello  world"), (3, "Hello  world"), (None, "x"))
    encoded = bpe.encode_documents(docs, PATH)
    back = sorted((r.doc_id or 0, r.text) for r in bpe.decode_documents(encoded, PATH).collect())
    assert back == [(0, "x"), (1, ""), (2, ""), (3, "Hello  world"), (3, "Hello  world")]
    assert bpe.round_trip(documents(), PATH).count() == 0
    whole = spark.read.parquet(f"{tiny}/documents.parquet")
    same = bpe.decode_documents(bpe.encode_documents(whole, PATH), PATH).withColumnRenamed("text", "back")
    assert whole.join(same, "doc_id").where("text <> back").count() == 0
