import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adsift.llm import packing, tokens, wavelet

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
TEXTS = ["", None, " ", "a", "  a  b ", "a\n b", "a\n \nb", "a \n b", "\n\n a", "a   b", "a\tb \x1c c", "it's 12 o'clock", "É́ 日本 語",
         "<|endoftext|> x <|startoftext|>", "İstanbul ΣΑΣ", "über Ärger ÇA, straße. ªº µm naïve ÿ Ÿ x² é́a", "word " * 3000, "x" * 9000]


def library(path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pieces_equal_whole_texts(path):
    encode, plain = tokens.Encoder(path, most=5), library(path)
    for _ in range(2):
        for text, data in zip(TEXTS, encode.encode([t or "" for t in TEXTS]), strict=True):
            assert np.frombuffer(data, "<u4").tolist() == plain(text), repr(text)[:60]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_any_white_space(path):
    encode, plain = tokens.Encoder(path), library(path)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.sampled_from([" ", " ", "\n", "\t", " ", " ", "\x1d", "a", "Bc", "'s", "1", "!", "é", "Ä", "ß", ".", ",", "$$", "-", "<|", "µ", "́"]), max_size=14).map("".join))
    def same(text):
        assert np.frombuffer(encode.encode([text])[0], "<u4").tolist() == plain(text)

    same()


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_words_of_all_scripts(path):
    """Words of every script and of random Latin letters, in long texts of single spaces, as the library reads them."""
    rng, plain = random.Random(8), library(path)
    letters = {s: [chr(c) for c in range(a, b) if chr(c).isalpha()] for s, a, b in (
        ("latin", 0x41, 0x7B), ("latin-1", 0xC0, 0x100), ("extended", 0x100, 0x250), ("greek", 0x370, 0x400), ("cyrillic", 0x400, 0x500),
        ("hebrew", 0x5D0, 0x5EB), ("arabic", 0x620, 0x64B), ("thai", 0xE01, 0xE31), ("kana", 0x3041, 0x3097), ("han", 0x4E00, 0x4F00))}
    texts = []
    for _ in range(60):
        words = ["".join(rng.choice(letters[rng.choice(list(letters)) if rng.random() < 0.2 else rng.choice(("latin", "latin", "latin-1"))])
                         for _ in range(rng.choice((1, 2, 5, 9, 14, 30)))) + rng.choice(("", "", "", ".", ",", ".\nAb", "\nx", "...", "***", ",%%%", "$", "!!\n", "<|>", "'", "'s", ".'t", "$$\nAb", "\n", "1", "-y")) for _ in range(80)]
        texts.append(" ".join(words).strip())
    for buffer in (64, 4 << 20):
        was, tokens.BUFFER_BYTES = tokens.BUFFER_BYTES, buffer
        try:
            got = tokens.Encoder(path).encode(texts)
        finally:
            tokens.BUFFER_BYTES = was
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [plain(t) for t in texts]


def test_documents_equal_the_library(spark):
    docs = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    for path in (BYTES, WORDS):
        plain = library(path)
        for text, ids in zip(docs, tokens.Encoder(path).encode(docs), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == plain(text)


def test_equal_hashes_are_noticed(monkeypatch):
    plain = library(BYTES)
    monkeypatch.setattr(tokens, "BASES", (0, *tokens.BASES))    # all units of a length would be the same
    assert np.frombuffer(tokens.Encoder(BYTES).encode(["some words here and there"])[0], "<u4").tolist() == plain("some words here and there")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=200), st.integers(1, 6))
def test_best_fit_against_a_plain_loop(lengths, most):
    fit, open_, n = packing.BestFit(50, most), [], 0
    for length in lengths:
        at, offset = fit.place(length)
        room = [b for b in open_ if b[1] >= length]
        if room:
            best = min(b[1] for b in room)
            mine = next(b for b in open_ if b[0] == at)
            assert mine[1] == best and offset == 50 - best
        else:
            assert (at, offset) == (n, 0)
            n += 1
            mine = [at, 50]
            if length < 50 and len(open_) == most:
                least = min(b[1] for b in open_)
                gone = [b for b in open_ if b[1] == least][-1]
                open_.remove(gone)
            open_.append(mine)
        mine[1] -= length
        if not mine[1]:
            open_.remove(mine)


def test_packing(docs):
    rows = list(enumerate(TEXTS)) + [(3, "a"), (None, "b c"), (99, "many words here " * 900)] + [(100 + i, "w " * (37 * i % 700)) for i in range(120)]
    out = packing.placements(packing.pack(docs(rows), WORDS)).collect()
    plain = library(WORDS)
    want, got = defaultdict(int), defaultdict(int)
    for doc_id, text in rows:
        ids = [*plain(text), 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want[doc_id, piece, start, len(part), crc(part)] += 1
    at = defaultdict(list)
    for r in out:
        got[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for parts in at.values():
        assert sum(n for _, n in parts) <= 2048
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
    total = sum(n for parts in at.values() for _, n in parts)
    assert len(at) <= total / 2048 * 1.05 + 3
    assert packing.pack(docs([]), WORDS).collect() == []


def test_wavelet_matrix():
    rng = np.random.default_rng(2)
    for n, top in ((0, 1), (1, 1), (513, 2), (3000, 50257), (700, 1 << 18)):
        ids = rng.integers(0, top, n).astype(np.uint32)
        doc_ids, lengths, m = wavelet.from_bytes(wavelet.to_bytes([5, None], [n, 0], ids))
        assert (doc_ids, lengths.tolist()) == ([5, None], [n, 0])
        assert (m.decode() == ids).all()
        for i in rng.integers(0, n, 30) if n else ():
            token = int(ids[i])
            assert m.access(int(i)) == token
            assert m.count(token, int(i)) == int((ids[:i] == token).sum())
            assert m.find(token, m.count(token, int(i))) == i
        assert m.count(1 << 20) == 0
        with pytest.raises(IndexError):
            m.find(0, int((ids == 0).sum()))


def test_shards(docs, spark):
    rows = list(enumerate(TEXTS)) + [(3, "a"), (3, "b"), (None, "b c"), (-4, "first")] + [(100 + i, "w " * (i % 70)) for i in range(120)]
    folder = wavelet.new_folder(spark)
    shards = wavelet.write_shards(docs(rows), BYTES, folder, shard_tokens=500)
    assert shards.count() > 4
    out = wavelet.digests(spark, shards, folder).orderBy("start").collect()
    plain = library(BYTES)
    want = sorted((str(doc_id), len(plain(text)) + 1, crc([*plain(text), 0])) for doc_id, text in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in out) == want
    ids = [r["doc_id"] for r in out]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    assert [r["start"] for r in out] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in out])[:-1]]).tolist()


def test_no_shards(docs, spark):
    folder = wavelet.new_folder(spark)
    assert wavelet.digests(spark, wavelet.write_shards(docs([]), BYTES, folder), folder).collect() == []


SPECIAL = ["foo <|endoftext|> bar", "<|endoftext|>", "a<|startoftext|>b", "x  <|endoftext|>  y", "a\n <|endoftext|>\n b", "a\t<|endoftext|> ", "word " * 3000 + "<|endoftext|> z"]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_special_strings_as_by_the_library(path):
    from tokenizers import Tokenizer

    plain, encode = Tokenizer.from_file(path), tokens.Encoder(path, most=5, specials=True)
    for text, data in zip(TEXTS + SPECIAL, encode.encode([t or "" for t in TEXTS + SPECIAL]), strict=True):
        assert np.frombuffer(data, "<u4").tolist() == plain.encode(text or "", add_special_tokens=False).ids, repr(text)[:60]


def test_queries_follow_the_library(docs, spark, monkeypatch):
    """Packing and shards as registered, and the pipeline's last stage."""
    import corpus_pipeline
    from adsift.llm import queries
    from tokenizers import Tokenizer

    table = docs(list(enumerate(SPECIAL)))
    monkeypatch.setattr(queries, "table", lambda *_: table)
    for path, out in ((WORDS, queries.op6_best_fit_pack(spark, "")), (WORDS, corpus_pipeline.pack_sequences(spark, table, "")),
                      (BYTES, queries.op7_wavelet_shards(spark, ""))):
        plain = Tokenizer.from_file(path)
        got = {r["doc_id"]: r["ids_crc32"] for r in out.collect() if r["doc_id"] < len(SPECIAL) - 1}
        assert got == {i: crc([*plain.encode(t, add_special_tokens=False).ids, 0]) for i, t in enumerate(SPECIAL[:-1])}
