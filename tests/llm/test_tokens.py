import random
import zlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from helpers import AWKWARD, docs, empty
from visitlens.llm import sentencepiece_fst, token_counts, token_files
from visitlens.llm.common import fresh_path
from visitlens.llm.queries import BYTE_MODEL, PIECE_MODEL


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


@pytest.fixture(scope="module")
def byte_level():
    return Tokenizer.from_file(BYTE_MODEL)


def noise(seed, n):
    rng = random.Random(seed)
    parts = list("  \n\n\t\r\x85\xa0abcXY09.,'é日　 😀\x00▁") + ["'s", " the", "ing", "<s>", "<|endoftext|>", "  ", "▁▁▁", "\x1c"]
    plain = list("abcdef .,\n") + [" the", "ing", "é"]
    return ["".join(rng.choice(parts if k % 2 else plain) for _ in range(rng.randint(0, 30))) for k in range(n)]


def test_transducer_equals_library(pieces):
    fst = sentencepiece_fst.PieceTransducer.load(PIECE_MODEL)
    rng = random.Random(5)
    vocabulary = [pieces.id_to_piece(i) for i in range(259, 32000)]
    texts = noise(1, 3000) + ["".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 6))).replace("▁", " ") for _ in range(3000)]
    ids, sizes = fst.encode_many(texts)
    stops = np.cumsum(sizes)
    for text, stop, n, wanted in zip(texts, stops, sizes, pieces.encode(texts)):
        assert ids[stop - n:stop].tolist() == wanted == fst.encode(text).tolist(), text
        assert fst.decode(ids[stop - n:stop]) == text.replace("▁", " ")


def test_unigram_path_is_the_lightest():
    kinds = [("<unk>", 0.0, 2), ("▁", -1.0, 1), ("a", -2.0, 1), ("b", -2.5, 1), ("ab", -3.0, 1), ("▁a", -2.6, 1), ("ba", -4.1, 1)]
    fst = sentencepiece_fst.PieceTransducer(kinds, bpe=False, byte_fallback=False)
    score = {p: s for p, s, k in kinds if k == 1}

    def best(s):
        if not s:
            return 0.0
        options = [score[s[:n]] + best(s[n:]) for n in (1, 2) if s[:n] in score]
        return max(options, default=-99.0)

    for text in ("abab", "baab", "aabba"):
        ids = fst.encode(text)
        assert sum(kinds[i][1] for i in ids) == pytest.approx(best("▁" + text))
    assert fst.encode("aza").tolist().count(0) == 1


def test_encode_and_decode_frames(spark, pieces):
    coded = sentencepiece_fst.encode(docs(spark), PIECE_MODEL)
    got = sorted(((r.doc_id, list(r.ids)) for r in coded.collect()), key=repr)
    assert got == sorted(((i, pieces.encode(t or "")) for i, t in AWKWARD), key=repr)
    back = sorted(((r.doc_id, r.text) for r in sentencepiece_fst.decode(coded, PIECE_MODEL).collect()), key=repr)
    assert back == sorted(((i, (t or "").replace("▁", " ")) for i, t in AWKWARD), key=repr)
    assert all(r.decoded_ok for r in sentencepiece_fst.round_trip(docs(spark), PIECE_MODEL).collect())
    assert sentencepiece_fst.round_trip(empty(spark), PIECE_MODEL).collect() == []


def test_token_counts(spark, pieces, byte_level):
    rows = AWKWARD + [(100 + k, t) for k, t in enumerate(noise(3, 300))]
    for path, count in ((PIECE_MODEL, lambda t: len(pieces.encode(t))), (BYTE_MODEL, lambda t: len(byte_level.encode(t, add_special_tokens=False).ids))):
        got = token_counts.token_counts(docs(spark, rows), path, limit=50).collect()
        wanted = [(i, len((t or "").encode()), count(t or ""), count(t or "") > 50) for i, t in rows]
        assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)
    assert token_counts.token_counts(empty(spark), PIECE_MODEL).collect() == []


def test_words_round_trip():
    rng = np.random.default_rng(0)
    for k in range(200):
        n = rng.integers(0, 300)
        ids = rng.integers(0, 2**63, n, dtype=np.uint64) >> rng.integers(0, 63, n).astype(np.uint64)
        if k % 5 == 0 and n:
            ids[rng.integers(0, n)] = np.uint64(2**64 - 1)  # an escape whose raw word looks like a selector
        words = token_files.pack(ids)
        assert (token_files.unpack(words, n) == ids).all()
    assert len(token_files.pack(np.zeros(60, np.uint64))) == 1


def test_files_round_trip(spark, byte_level):
    rows = [r for r in AWKWARD if r[0] is not None] + [(None, "no id")]
    out = fresh_path(spark, "test-token-files")
    token_files.write(docs(spark, rows), BYTE_MODEL, out, end_id=0, block_ids=500)
    got = sorted((tuple(r) for r in token_files.read(spark, out).collect()), key=lambda r: r[1])
    start, wanted = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = byte_level.encode(text or "", add_special_tokens=False).ids + [0]
        wanted.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == wanted
    texts = {(r.doc_id, r.text) for r in token_files.decode_texts(spark, out, BYTE_MODEL).collect()}
    assert texts == {(i, t or "") for i, t in rows}
    nothing = fresh_path(spark, "test-token-files")
    token_files.write(empty(spark), BYTE_MODEL, nothing)
    assert token_files.read(spark, nothing).collect() == []
