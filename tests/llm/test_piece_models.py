"""Piece models of all four kinds, put together by hand, against the library."""

import itertools
import random
import struct

import numpy as np
import pytest
import sentencepiece

from visitlens.llm.sentencepiece_fst import PieceTransducer, character_map

LETTERS = list("abcdeXé$.日") + ["▁"]
SPOKEN = ["▁the", "ing", "ab", "$$", "▁a", "cd", "de", "abc", "▁▁", "▁▁▁", "ba", "dede", "ee", "eee", "日日"]


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def field(number, value):
    if isinstance(value, bool) or isinstance(value, int):
        return varint(number << 3) + varint(int(value))
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def model(pieces, bpe, fallback, normaliser):
    kinds = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    kinds += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if fallback else []
    kinds += [(p, s, 1) for p, s in pieces]
    body = b"".join(field(1, field(1, p.encode()) + field(2, float(s)) + field(3, k)) for p, s, k in kinds)
    return body + field(2, field(3, 2 if bpe else 1) + field(35, fallback)) + field(3, normaliser)


def identity(prefix=True, squeeze=False):
    return field(1, b"identity") + field(3, prefix) + field(4, squeeze) + field(5, True)


def vocabulary(bpe, seed):
    rng = random.Random(seed)
    if bpe:  # every piece is a pair of earlier ones, as merges leave them
        pieces = list(LETTERS)
        while len(pieces) < 120:
            p = rng.choice(pieces) + rng.choice(pieces)
            if p not in pieces and "▁" not in p.lstrip("▁") and len(p) < 8:
                pieces.append(p)
        return [(p, -float(i)) for i, p in enumerate(pieces)]
    pieces = LETTERS + SPOKEN + ["t", "h", "i", "n", "g"]
    return [(p, -rng.choice([1.5, 2.0, 3.1, 7.3, 4.05])) for p in pieces]  # many equal weights


def lines(seed, n, longest=40):
    rng = random.Random(seed)
    parts = LETTERS + [" ", " ", "  ", "\n", "the", "ing", "$$$", "☃", "☃☃", "😀", "<unk>", "<s>", "\t", "q"]
    return ["".join(rng.choices(parts, k=rng.randint(0, longest))) for _ in range(n)] + ["", " ", "▁", "☃\n☃", "☃ ☃", " a", "a "]


def compare(blob, tmp_path, texts):
    file = tmp_path / "hand.model"
    file.write_bytes(blob)
    library, fst = sentencepiece.SentencePieceProcessor(model_proto=blob), PieceTransducer.load(str(file))
    ids, sizes = fst.encode_many(texts)
    for text, wanted, got in zip(texts, library.encode(texts), np.split(ids, np.cumsum(sizes)[:-1])):
        assert got.tolist() == wanted, text
        assert fst.encode(text).tolist() == wanted
    return library, fst


@pytest.mark.parametrize("bpe,fallback", list(itertools.product((True, False), (True, False))))
def test_four_kinds_of_models(bpe, fallback, tmp_path):
    for seed, normaliser in enumerate((identity(), identity(False), identity(True, True), identity(False, True))):
        compare(model(vocabulary(bpe, seed), bpe, fallback, normaliser), tmp_path, lines(seed, 800))


def test_sums_of_single_precision_decide_in_long_texts(tmp_path):
    for seed in range(4):
        compare(model(vocabulary(False, seed), False, True, identity()), tmp_path, lines(seed, 6, 6000))


@pytest.fixture(scope="module")
def usual():
    return sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")


def test_usual_normaliser(usual, tmp_path):
    spec = usual.serialized_normalizer_spec() if callable(usual.serialized_normalizer_spec) else usual.serialized_normalizer_spec
    odd = ["ﬁ ﾊﾟ ａｂ　ｃ ㌔ ①½", "​a​ b", "﻿", "é é Å ṩ", "a\t\nb\r\n c ", "   x  ", "¨a ¨", "한글 각 ﷺ", "\x00\x01a\x7f", "▁▁a▁"]
    rng = random.Random(9)
    wild = ["".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(0x300, 0xD7FF), rng.randint(0xF900, 0x1FFFF), 32, 97])) for _ in range(20))
            for _ in range(1500)]
    for bpe, fallback in itertools.product((True, False), (True, False)):
        library, fst = compare(model(vocabulary(bpe, 1), bpe, fallback, spec), tmp_path, odd + wild + lines(5, 200))
    for text in odd + wild:
        assert fst.normalise(text) == library.normalize(text), text


def test_character_map_without_rewrites():
    assert character_map(b"") == {}
    fst = PieceTransducer([("<unk>", 0.0, 2), ("a", -1.0, 1)], bpe=False, byte_fallback=False, rewrites={"bb": "a", "b": "c", "bbb": ""})
    assert fst.normalise("abb b bbbbb") == "▁aa▁c▁a"


def test_models_that_are_refused(tmp_path):
    for blob in (model([("a", 0.0)], True, True, field(3, True) + field(5, False)),
                 model([("a▁b", 0.0)], True, True, identity()),
                 field(1, field(1, b"a") + field(3, 4)) + model([("b", 0.0)], True, True, identity())):
        file = tmp_path / "no.model"
        file.write_bytes(blob)
        with pytest.raises(ValueError):
            PieceTransducer.load(str(file))
