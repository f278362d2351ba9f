import hashlib
import random
import struct

import numpy as np
import pytest
from tokenizers import Tokenizer

from pitlane.llm.bpe import (
    VOCABULARY, Encoder, Vocabulary, decode_documents, encode_documents, token_digests,
    vocabulary_file,
)

PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", "'T", "ñ", "中", "😀", "1", "２", "\u0085", "\x1c",
         "　", "​", "é", "!", "aaaa", "the", " the", "\r\n", "ſ", "ⅷ", "%", "zzzzzz",
         "<|endoftext|>", "<|endof", "thereof", "_", "-", "Ġ"]


@pytest.fixture(scope="module")
def both():
    return Encoder(Vocabulary(vocabulary_file())), Tokenizer.from_file(VOCABULARY)


def ids(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_random_texts_against_the_library(both):
    encoder, library = both
    r = random.Random(5)
    for _ in range(4000):
        text = "".join(r.choice(PARTS) for _ in range(r.randint(0, 30)))
        assert encoder.encode(text).tolist() == ids(library, text), text
        expected = library.decode(ids(library, text), skip_special_tokens=False)
        assert encoder.vocabulary.decode(encoder.encode(text)) == expected


def test_every_kind_of_character(both):
    encoder, library = both
    for start in range(1, 0x3000, 97):
        text = " ".join(f"a{chr(c)}b {chr(c)}1 {chr(c)}{chr(c)} x" for c in range(start, start + 97))
        assert encoder.encode(text).tolist() == ids(library, text)


def test_long_pieces_take_linear_time(both):
    encoder, library = both
    r = random.Random(1)
    text = "".join(r.choice("abcdefgh") for _ in range(60_000))
    assert encoder.encode(text).tolist() == ids(library, text)


def test_forgetting_changes_nothing(both, monkeypatch):
    monkeypatch.setattr("pitlane.llm.common.REMEMBERED", 3)
    monkeypatch.setattr("pitlane.llm.bpe.REMEMBERED", 3)
    encoder, library = Encoder(both[0].vocabulary), both[1]
    text = "some of the words come again and some of the words do not, come what may"
    assert encoder.encode(text).tolist() == ids(library, text)


def test_other_vocabularies_are_refused():
    spec = vocabulary_file().replace('"add_prefix_space":false', '"add_prefix_space":true')
    spec = spec.replace('"add_prefix_space": false', '"add_prefix_space": true')
    with pytest.raises(ValueError, match="byte-level"):
        Vocabulary(spec)


def test_digests(edge, both):
    rows, docs = edge
    expected = []
    for i, text in rows:
        found = ids(both[1], text or "")
        decoded = both[1].decode(found, skip_special_tokens=False)
        expected.append((i, len(found), hashlib.sha256(struct.pack(f"<{len(found)}I", *found)).hexdigest(),
                         hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, token_digests(docs).collect()), key=repr) == sorted(expected, key=repr)


def test_round_trip_of_tables(edge, spark):
    rows, docs = edge
    there = encode_documents(docs.select("doc_id", "text", "source"))
    back = decode_documents(there)
    assert back.columns == ["doc_id", "source", "text"]
    assert sorted((r.doc_id, r.text) for r in back.filter("doc_id is not null").collect()) == sorted(
        (i, t or "") for i, t in rows if i is not None)


def test_blocks_of_tokens_decode_alike(both, monkeypatch):
    encoder = both[0]
    found = encoder.encode("A text of more than a few tokens, decoded in blocks of three.")
    monkeypatch.setattr("pitlane.llm.bpe.BLOCK", 3)
    assert encoder.vocabulary.decode(found).startswith("A text of more")
    assert encoder.vocabulary.decode(np.array([], np.int64)) == ""


def test_empty(empty):
    assert token_digests(empty).collect() == []
