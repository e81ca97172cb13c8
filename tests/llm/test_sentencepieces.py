from __future__ import annotations

import hashlib
import random
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SMALL_SF
from llm.nasty import TEXTS, documents
from sentencepiece import sentencepiece_model_pb2

from lakestrata.llm.queries import QUERIES
from lakestrata.llm.sentencepieces import CharacterMap, Codec, encoded

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = Path(PATH).read_bytes()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PARTS = [*"ab  \n\t▁é你😀<s>the.inǵ\x00 ", "the", "▁", "  ", "<unk>", "<0x0A>", "　", "Ａ", "ﬁ", "㍿", "é", "ΑΣ"]


@pytest.fixture(scope="module")
def codec():
    return Codec(MODEL)


def odd_texts(count):
    pick = random.Random(11)
    return ["".join(pick.choices(PARTS, k=pick.randint(0, 40))) for _ in range(count)]


def changed(**spec):
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(MODEL)
    for name, value in spec.items():
        setattr(proto.normalizer_spec, name, value)
    return proto


def character_map():
    """A compiled map from the library's own rules."""
    rules = sentencepiece.SentencePieceNormalizer(rule_name="nfkc")
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(rules.serialized_model_proto())
    return proto.normalizer_spec.precompiled_charsmap


def test_equals_the_library(codec):
    for text in odd_texts(3000) + [t or "" for _, t in TEXTS] + ["a" * 3000 + "你好" * 500]:
        ids, places = codec.encode(text)
        assert ids.tolist() == LIBRARY.encode(text)
        assert codec.decode(ids) == LIBRARY.decode(ids.tolist())
        assert places[0] == 0 and places[-1] == len(text.encode()) and (np.diff(places) >= 0).all()


def test_places_cut_the_text_into_pieces(codec):
    for text in odd_texts(500):
        if "▁" in text:
            continue
        raw = text.encode()
        ids, places = codec.encode(text)
        for n, (i, a, b) in enumerate(zip(ids.tolist(), places[:-1], places[1:], strict=True)):
            piece = bytes([codec.byte_of[i]]) if i in codec.byte_of else codec.pieces[i].replace("▁", " ").encode()
            # The first sign stands for no byte of the text.
            assert raw[a:b] == (piece[1:] if n == 0 else piece)


def test_the_identity_is_the_projection_through_an_empty_map():
    for dummy in (True, False):
        own = Codec(changed(add_dummy_prefix=dummy).SerializeToString())
        assert own.identity
        for text in odd_texts(800) + ["", " ", "a b  c"]:
            made, places = own._identity(text)
            slow, by_byte = own.normalise(text)
            assert made == slow and places.tolist() == by_byte.tolist()


def test_places_are_the_spans_of_the_library(codec):
    """Begin and end of every piece, but for the bytes of a character, of which the library gives the whole."""
    for text in odd_texts(1500) + ["The end.", " two  spaces ", "né à\nla fin"]:
        ids, places = codec.encode(text)
        pieces = LIBRARY.encode(text, return_type="proto").pieces
        assert [p.id for p in pieces] == ids.tolist()
        for piece, a, b in zip(pieces, places[:-1], places[1:], strict=True):
            if piece.id not in codec.byte_of:
                assert (piece.begin, piece.end) == (a, b)


def test_query_gives_the_places(spark):
    rows = QUERIES["op6_sentencepiece"](spark, SMALL_SF).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL_SF}/documents.parquet").collect()}
    own = Codec(MODEL)
    assert len(rows) == len(texts)
    for row in rows:
        ids = LIBRARY.encode(texts[row["doc_id"]])
        places = own.normalise(texts[row["doc_id"]])[1][np.r_[0, np.cumsum(own.widths[ids])]] if ids else [0]
        digest = {"ids_sha256": ids, "places_sha256": list(places)}
        for name, numbers in digest.items():
            assert row[name] == hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


def test_random_ids_decode_as_in_the_library(codec):
    pick = random.Random(4)
    for _ in range(500):
        ids = [pick.randrange(3, len(codec.pieces)) for _ in range(pick.randint(0, 12))]
        ids = [i for i in ids if i not in codec.byte_of or codec.byte_of[i] < 0x80]
        assert codec.decode(np.array(ids, np.int32)) == LIBRARY.decode(ids)


@pytest.mark.parametrize("squeeze", [False, True])
@pytest.mark.parametrize("dummy", [False, True])
def test_compiled_map(squeeze, dummy):
    proto = changed(precompiled_charsmap=character_map(), remove_extra_whitespaces=squeeze, add_dummy_prefix=dummy)
    own = Codec(proto.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    for text in odd_texts(1500):
        ids, places = own.encode(text)
        assert ids.tolist() == library.encode(text), text
        assert len(places) == len(ids) + 1 and (np.diff(places) >= 0).all() and places[-1] <= len(text.encode())


def test_places_through_the_map():
    own = Codec(changed(precompiled_charsmap=character_map()).SerializeToString())
    text = "ﬁne ㍿x"
    made, places = own.normalise(text)
    assert made == "▁fine▁株式会社x"
    at = made.encode().index("株".encode())
    assert places[at] == len("ﬁne ".encode()) and places[-1] == len(text.encode())
    assert places[made.encode().index(b"i")] == 0


def test_longest_entry_wins():
    blob = character_map()
    table = CharacterMap(blob)
    assert table.longest("é".encode(), 0) == (3, "é".encode())
    assert table.longest(b"plain", 0) is None


def test_documents(spark):
    rows = encoded(documents(spark), MODEL).collect()
    assert len(rows) == len(TEXTS)
    got = sorted((r["doc_id"] or -1, tuple(r["ids"]), r["decoded"]) for r in rows)
    want = sorted((i or -1, tuple(LIBRARY.encode(t or "")), LIBRARY.decode(LIBRARY.encode(t or ""))) for i, t in TEXTS)
    assert got == want
    assert all(len(r["places"]) == len(r["ids"]) + 1 for r in rows)
    assert encoded(documents(spark).limit(0), MODEL).count() == 0
