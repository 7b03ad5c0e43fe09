import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelmeter.llm import packing, token_files
from reelmeter.llm.tokens import tokenizer_path, word_tokens

TEXTS = [
    None, "", " ", "Hello, World!", "don't DON'T it's", "a<|endoftext|>b <|endoftext|>", "ΑΣ Σ ς İı ǅ", "é é Ünï", "x\x85y\x1cz\xa0w",
    "1234 56,7 ½", "#$%& *** a###", "한국어 漢字", "ﬁ ſ", "​q­q", "word. word, word; 'tis 's", "😀 ok",
]


def _encoded(texts):
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    out = []
    for first, ids, ends in word_tokens(tokenizer_path()).documents(batch):
        assert first == len(out)
        out += [x.tolist() for x in np.split(ids, ends[:-1])]
    return out


def test_fixed_texts():
    assert _encoded(TEXTS) == [brute.token_ids(t) for t in TEXTS]


def test_special_tokens_in_other_letter_case():
    texts = ["a <|ENDOFTEXT|> b", "A<|StartOfText|>B <|endoftext|> C", "É <|Endoftext|> <|", "<|ENDOFTEXT|> ΑΣ"]
    assert _encoded(texts) == [brute.token_ids(t) for t in texts]
    assert _encoded(texts)[0] == [320, 27, 347, 40786, 4160, 91, 285, 321, 1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=5))
def test_any_text(texts):
    assert _encoded(texts) == [brute.token_ids(t) for t in texts]


def test_slices_and_forgetting(monkeypatch):
    from reelmeter.llm import tokens

    monkeypatch.setattr(tokens, "AT_ONCE", 40)
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    tokens.word_tokens(tokenizer_path()).known.clear()
    assert _encoded(TEXTS * 3) == [brute.token_ids(t) for t in TEXTS * 3]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aséß÷ÿtA'.,<|>\"1 \n", max_size=30), min_size=1, max_size=5))
def test_letters_and_marks(texts):
    assert _encoded(texts) == [brute.token_ids(t) for t in texts]


def _invented(n):
    letters = "abcdefghijklmnopqrstuvwxyz"
    return ["".join(letters[k // 26**i % 26] for i in range(4)) for k in range(n)]


def test_words_are_encoded_once(monkeypatch):
    """120,000 words, each with three marks behind it, within the bytes that are remembered."""
    from reelmeter.llm import tokens

    words, found = _invented(120_000), tokens.WordTokens(tokenizer_path())
    texts = [" ".join(w + mark for w in words[k : k + 5000]) for mark in (".", ",", ")") for k in range(0, 120_000, 5000)]
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts[k : k + 24])}) for k in (0, 24, 48)]
    for batch in batches[:1]:
        list(found.documents(batch))
    encoded, plain = [], found._encode
    monkeypatch.setattr(found, "_encode", lambda w: encoded.append(len(w)) or plain(w))
    for batch in batches:
        list(found.documents(batch))
    assert sum(encoded) == 2  # the other two marks


def test_remembered_bytes_are_bounded(monkeypatch):
    from reelmeter.llm import tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 100_000)
    monkeypatch.setattr(tokens, "TOGETHER", 50_000)
    monkeypatch.setattr(tokens, "AT_ONCE", 20_000)
    monkeypatch.setattr(tokens, "_WORDS", 700)
    found, words = tokens.WordTokens(tokenizer_path()), _invented(30_000)
    texts = [" ".join(words[k : k + 1000]) for k in range(0, 30_000, 1000)] * 2 + ["x" * 50_000]
    got = []
    for _, ids, ends in found.documents(pa.RecordBatch.from_pydict({"text": pa.array(texts)})):
        got += [x.tolist() for x in np.split(ids, ends[:-1])]
        assert found.known.words.nbytes + found.known.ids.nbytes <= 100_000
    assert got == [brute.token_ids(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.sampled_from(["bit", "byte"]))
def test_planes(ids, planes):
    ids = np.array(ids, "<u4")
    assert (token_files.decode_segment(*token_files.encode_segment(ids, planes), planes) == ids).all()


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_files(spark, tmp_path, monkeypatch, planes):
    docs = [(i * 7 % 101, f"text number {i} " * (i % 9)) for i in range(101)] + [(500, None), (-3, "x " * 5000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    token_files.write_token_files(frame, str(tmp_path / "t"), planes=planes)
    got = {r[0]: tuple(r[1:]) for r in token_files.read_documents(spark, str(tmp_path / "t")).collect()}
    assert got == brute.token_files(docs)
    ids = {r[0]: list(r[1]) for r in token_files.read_ids(spark, str(tmp_path / "t")).collect()}
    assert ids == {d: brute.token_ids(t) for d, t in docs}


def test_chunks_and_segments(monkeypatch):
    monkeypatch.setattr(token_files, "CHUNK", 64)
    ids = np.arange(1000, dtype="<u4") * 77
    sizes, ends, payload = token_files.encode_segment(ids, "byte")
    assert sizes == [64] * 15 + [40] and len(ends) == 64 and ends[-1] == len(payload)
    assert (token_files.decode_segment(sizes, ends, payload, "byte") == ids).all()


def test_odd_rows(spark, odd_documents, no_documents, tmp_path):
    token_files.write_token_files(odd_documents, str(tmp_path / "t"))
    got = token_files.read_documents(spark, str(tmp_path / "t")).collect()
    assert len(got) == odd_documents.count()
    spans = sorted((r["start"], r["start"] + r["n_tokens"]) for r in got)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    token_files.write_token_files(no_documents, str(tmp_path / "n"))
    assert token_files.read_documents(spark, str(tmp_path / "n")).count() == 0


def _places(rows):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for at in by.values():
        end = 0
        for offset, length in sorted(at):
            assert offset == end
            end += length
        assert end <= 4096
    return len(by)


def test_packing(spark):
    r = random.Random(1)
    docs = [(i, "word " * r.choice([1, 20, 300, 900, 5000])) for i in range(150)] + [(900, None), (901, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = packing.pack_documents(frame).collect()
    assert {(x["doc_id"], x["piece"]): (x["start"], x["length"], x["ids_crc32"]) for x in rows} == brute.pieces(docs)
    assert _places(rows) <= -(-sum(x["length"] for x in rows) // 4096) * 1.03 + 1
    packed = spark.createDataFrame(rows)
    for s in packing.sequences(frame, packed).collect():
        want = sorted((x["offset"], x["doc_id"], x["piece"]) for x in rows if x["sequence_id"] == s["sequence_id"])
        ids = {d: brute.token_ids(t) for d, t in docs}
        assert list(s["ids"]) == [i for _, d, p in want for i in ids[d][4096 * p : 4096 * (p + 1)]]
        assert list(s["starts"]) == [o for o, _, _ in want]


def test_pieces_encode_words_once(monkeypatch):
    """Pieces of texts whose words came before, in other order and with other marks, need nothing encoded but a mark."""
    words = _invented(100_000)
    first = [(k, " ".join(words[k : k + 5000])) for k in range(0, 100_000, 5000)]
    again = [(k, "; ".join(words[k % 20 :: 20])) for k in range(20)]
    rows = [pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in x], "text": [t for _, t in x]}) for x in (first, again)]
    tokens = word_tokens(tokenizer_path())
    list(packing._pieces(iter(rows[:1]), tokenizer_path(), 4096))
    encoded, plain = [], tokens._encode
    monkeypatch.setattr(tokens, "_encode", lambda w: encoded.append(len(w)) or plain(w))
    got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"])
           for b in packing._pieces(iter(rows[1:]), tokenizer_path(), 4096) for r in b.to_pylist()}
    assert got == brute.pieces(again) and sum(encoded) <= 1


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity(rule):
    r = np.random.default_rng(2)
    lengths = r.integers(1, 1000, 400)
    capacity = packing.Capacity(tokens=1000, documents=3, cost=600_000, rule=rule)
    bins, offsets = packing.best_fit(lengths, capacity)
    for b in np.unique(bins):
        own = lengths[bins == b]
        assert own.sum() <= 1000 and len(own) <= 3 and ((own**2).sum() <= 600_000 or len(own) == 1)
        order = np.argsort(offsets[bins == b])
        assert (offsets[bins == b][order] == np.cumsum(own[order]) - own[order]).all()
    with pytest.raises(ValueError):
        packing.best_fit(np.array([1001]), capacity)
    assert len(packing.best_fit(np.array([], int), capacity)[0]) == 0


def test_packing_odd_rows(spark, odd_documents, no_documents):
    rows = packing.pack_documents(odd_documents).collect()
    _places(rows)
    n = sum(-(-len(brute.token_ids(r["text"])) // 4096) for r in odd_documents.collect())
    assert len(rows) == n
    assert packing.pack_documents(no_documents).count() == 0
