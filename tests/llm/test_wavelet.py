"""Wavelet-matrix files: token access, counting, search, round trip."""

import time
import zlib

import numpy as np
import pytest
from helpers import awkward, nothing
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cartwheel.llm import wavelet
from cartwheel.llm.queries import END_ID, WORD_TOKENIZER, op11_wavelet
from cartwheel.llm.wavelet import PieceEncoder, WaveletMatrix, count_token, find_token, read_documents, write_ids

SF = "/root/testdata/sf0.001"


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 70_000), max_size=300), st.integers(1, 8))
def test_matrix_against_a_list(tokens, eighths):
    old, wavelet.BLOCK = wavelet.BLOCK, 8 * eighths  # many blocks
    try:
        m = WaveletMatrix(WaveletMatrix.build(np.array(tokens, np.uint32)))
        assert len(m) == len(tokens) and m.decode().tolist() == tokens
        for token in {*tokens[:5], 0, 3, 70_001, 1 << 30}:
            places = [i for i, t in enumerate(tokens) if t == token]
            assert m.count(token) == len(places) and m.occurrences(token).tolist() == places
            assert m.occurrences(token, 5, 50).tolist() == [i for i in places if 5 <= i < 50]
            assert [m.select(token, j) for j in range(len(places))] == places
            assert m.rank(token, 7) == tokens[:7].count(token)
            with pytest.raises(IndexError):
                m.select(token, len(places))
        assert [m.access(i) for i in range(len(tokens))] == tokens
    finally:
        wavelet.BLOCK = old


def test_matrix_of_several_blocks():
    tokens = np.random.default_rng(1).zipf(1.3, 200_000) % 49_408
    data = WaveletMatrix.build(tokens)
    m = WaveletMatrix(data)
    assert (m.decode() == tokens).all() and len(data) < 2 * len(tokens)
    for token in (1, 2, 40_000):
        assert m.occurrences(token).tolist() == np.flatnonzero(tokens == token).tolist()
    assert [m.access(i) for i in (0, 65_535, 65_536, 199_999)] == tokens[[0, 65_535, 65_536, 199_999]].tolist()


ODD = ["it's  they'LL\u00a0x\u2003y\x1fz\x85w", "<|endoftext|>a <|startoftext|> b<|endoftext|>", "\u0301a e\u0301 \u0323\u0301b",
       "\u0130stanbul \u03a3\u03a3 \u03c3\u03a3 \u1e9e", "a\u200bb \ufeffc", "1234 5,6.7 --- ... 'S 'd", "\x00 \x0b\x0c\r\n", "\u4e2d\u6587 \U0001f600" * 50]


def plain(texts):
    t = Tokenizer.from_file(WORD_TOKENIZER)
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_pieces_give_the_numbers_of_whole_texts(spark):
    texts = ODD + [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    with open(WORD_TOKENIZER, encoding="utf-8") as f:
        coder = PieceEncoder(f.read(), keep=50, longest=5)
    got = []
    for part in (texts[:40], texts[40:], []):
        tokens, counts = coder.encode([t.encode() for t in part])
        got += [x.tolist() for x in np.split(tokens, np.cumsum(counts)[:-1])] if part else []
    assert got == plain(texts)


def test_pieces_of_one_hash_are_told_apart(monkeypatch):
    texts = [b"ab ba  ab", b"", b" \n", b"ba\tc abc"]
    want = wavelet._distinct_pieces(texts)
    monkeypatch.setattr(wavelet, "_POWERS", np.ones(4096, np.uint64))  # anagrams collide
    for pieces, which, of_text in (want, wavelet._distinct_pieces(texts)):
        assert [pieces[i] for i in which] == [b"ab", b"ba", b"ab", b"ba", b"c", b"abc"]
        assert len(pieces) == 4 and of_text.tolist() == [0, 0, 0, 3, 3, 3]


def test_longer_pieces_of_one_hash_are_told_apart(monkeypatch):
    halves = b"abcdefgh" b"ijklmnop" + b" " + b"ijklmnop" b"abcdefgh" + b" " + b"abcdefgh" b"ijklmnop"
    texts = [halves, b"x" * 64 + b" " + b"x" * 65 + b"\t" + b"x" * 65, b"a a\x00 a\x00\x00 a"]
    want = [t.split() for t in texts]
    for powers in (wavelet._POWERS, np.ones(4096, np.uint64)):  # swapped halves collide
        monkeypatch.setattr(wavelet, "_POWERS", powers)
        for some, words in ((texts, want), (texts[::2], want[::2])):
            pieces, which, of_text = wavelet._distinct_pieces(some)
            assert [pieces[i] for i in which] == sum(words, []) and len(set(pieces)) == len(pieces)
            assert np.bincount(of_text).tolist() == [len(w) for w in words]


def test_steady_words_go_to_the_model_alone():
    """Words of lower-case letters need no normaliser and no splitting rule."""
    words = ["fox", "\u00fcber", "na\u00efve", "\u0441\u043b\u043e\u0432\u043e", "\u03c3\u03bf\u03c6\u03cc\u03c2",
             "qzxjvw" * 9]
    with open(WORD_TOKENIZER, encoding="utf-8") as f:
        coder = PieceEncoder(f.read())
    coder.tokenizer = None
    tokens, counts = coder.encode([f"Fox {w}\n".encode() for w in words])
    assert [x.tolist() for x in np.split(tokens, np.cumsum(counts)[:-1])] == plain([f"Fox {w}" for w in words])
    for odd in ("\u0130", "\u00b2", "e\u0301", "\u1100\u1161", "\ufb01", "\u01c5", "it's", "a1", "A"):
        assert not coder.steady(f"a{odd}b")
    every = ["a" + chr(i) + "b" for i in range(0x80, 0x600)] + ["\u00e9\u00e8" + chr(i) for i in range(0x61, 0x530)]
    with open(WORD_TOKENIZER, encoding="utf-8") as f:
        coder = PieceEncoder(f.read())
    tokens, counts = coder.encode([w.encode() for w in every])
    assert [x.tolist() for x in np.split(tokens, np.cumsum(counts)[:-1])] == plain(every)


def test_words_met_among_400_000_others_are_not_encoded_again():
    with open(WORD_TOKENIZER, encoding="utf-8") as f:
        coder = PieceEncoder(f.read())
    letters = np.random.default_rng(3).integers(97, 123, (400_000, 7), np.uint8)
    texts = [b" ".join(x.tobytes() for x in part) for part in np.split(letters, 10)]
    first = [coder.encode([text])[0] for text in texts]
    coder._learn = None
    assert all((coder.encode([text])[0] == numbers).all() for text, numbers in zip(texts, first))


def test_signs_met_alone_are_not_cut_from_signs():
    with open(WORD_TOKENIZER, encoding="utf-8") as f:
        coder = PieceEncoder(f.read())
    for text in ("< \u0301 \u00b2", "<, \u0301# \u00b2."):
        assert coder.encode([text.encode()])[0].tolist() == plain([text])[0]


def test_kept_pieces_are_bounded_by_their_bytes():
    with open(WORD_TOKENIZER, encoding="utf-8") as f:
        coder = PieceEncoder(f.read(), keep=1000)
    letters = np.random.default_rng(3).integers(97, 123, (4000, 60), np.uint8)
    for part in np.split(letters, 100):
        coder.encode([b" ".join(x.tobytes() for x in part)])
        size = [sum(len(piece) + len(numbers) for piece, numbers in x.items()) for x in (coder.young, coder.old)]
        assert max(size) < 32 * 1000 + 40 * 300 and size[0] == coder.held


def test_planes_take_little_time():
    """Thread time of making and reading a matrix against moving its tokens by places."""
    tokens = np.random.default_rng(0).integers(0, 49_408, 1_000_000)
    bits = (tokens[:65_536] & 1).astype(bool)
    piece = tokens[:65_536].astype(np.uint16)

    def seconds(run):
        best = np.inf
        for _ in range(5):
            start = time.thread_time()
            run()
            best = min(best, time.thread_time() - start)
        return best

    unit = seconds(lambda: [piece.take(np.flatnonzero(b)) for b in (bits, ~bits) for _ in range(100)]) / 100
    planes = 16 * len(tokens) / 65_536
    data = WaveletMatrix.build(tokens)
    assert seconds(lambda: WaveletMatrix.build(tokens)) < 2 * planes * unit
    assert seconds(lambda: WaveletMatrix(data).decode()) < 2 * planes * unit


@settings(deadline=None, max_examples=100)
@given(st.one_of(st.text(max_size=60), st.text("aB\u00e9\u0301'.,#s <|\u2160\u00aa\n", max_size=30)))
def test_pieces_of_any_text(text):
    global CODER
    if "CODER" not in globals():
        with open(WORD_TOKENIZER, encoding="utf-8") as f:
            CODER = PieceEncoder(f.read())
    tokens, counts = CODER.encode([text.encode()])
    assert tokens.tolist() == plain([text])[0] and counts.tolist() == [len(tokens)]


def brute_force(rows):
    """[(doc_id, start, n, crc)] of (doc_id, text) rows in file order."""
    out, start = [], 0
    for (doc_id, _), ids in zip(rows, plain([t or "" for _, t in rows])):
        data = np.array([*ids, END_ID], "<u4").tobytes()
        out.append((doc_id, start, len(ids) + 1, zlib.crc32(data)))
        start += len(ids) + 1
    return out


def test_query_against_brute_force(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = op11_wavelet(spark, SF).orderBy("start").collect()
    assert [tuple(r) for r in got] == brute_force(rows)


def test_awkward_rows_and_questions_to_the_files(spark, tmp_path):
    with open(WORD_TOKENIZER, encoding="utf-8") as f:
        tokenizer = f.read()
    path = str(tmp_path / "ids")
    write_ids(awkward(spark).repartition(4), path, tokenizer, END_ID, shard_tokens=50)  # several shards
    got = [tuple(r) for r in read_documents(spark, path).orderBy("start").collect()]
    ids = [g[0] for g in got]
    assert ids == sorted((i for i in ids if i is not None)) + [None, None]
    texts = awkward(spark).select("doc_id", "text").collect()
    want = {(i, n, crc) for i, _, n, crc in brute_force([tuple(r) for r in texts])}
    assert {(i, n, crc) for i, _, n, crc in got} == want and len(got) == len(texts)
    assert [g[1] for g in got] == np.cumsum([0, *[g[2] for g in got]])[:-1].tolist()
    assert count_token(spark, path, END_ID).collect() == [(END_ID, len(texts))]
    token = plain(["fox"])[0][0]
    assert sorted(tuple(r) for r in find_token(spark, path, token).collect()) == [(1, 3), (2, 3)]
    write_ids(nothing(spark), path, tokenizer, END_ID)
    assert read_documents(spark, path).count() == 0 and count_token(spark, path, 5).first()["count"] == 0
