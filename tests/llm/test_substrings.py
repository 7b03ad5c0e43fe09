import random

import numpy as np
import pytest

from reelmeter.llm import substrings as s


def _gear(data):
    out, h = [], 0
    for b in data:
        h = ((h << 1) + int(s.GEAR[b])) & 0xFFFF
        out.append(h)
    return out


def test_gear_hash():
    data = np.random.default_rng(0).integers(0, 256, 500).astype(np.uint8)
    assert s.gear(data).tolist() == _gear(data.tolist())


def plain_chunks(text, least=s.LEAST_WORDS, mean=s.MEAN_WORDS):
    """(first, words, chunk) one word after the other."""
    raw = text.encode()
    words, at = [], None
    for i, b in enumerate(raw + b" "):
        if b in (9, 10, 11, 12, 13, 32):
            if at is not None:
                words.append((at, i))
            at = None
        elif at is None:
            at = i
    h = _gear(raw)
    cuts = [k for k, (a, _) in enumerate(words) if k == 0 or h[a - 1] < 65535 // mean] + [len(words)]
    out = []
    for i, c in enumerate(cuts[:-1]):
        stop = next((x for x in cuts[i + 1 :] if x >= c + least), None)
        if stop is not None:
            out.append((c, stop - c, raw[words[c][0] : words[stop - 1][1]]))
    return len(words), out


def _prose(r, n):
    return " ".join("".join(r.choice("etaoins") for _ in range(r.randint(2, 9))) for _ in range(n))


@pytest.mark.parametrize("seed", range(6))
def test_chunks(seed):
    r = random.Random(seed)
    text = _prose(r, r.randint(0, 120)).replace("e", r.choice("eé"), 9) + r.choice(["", " ", "\n\n"])
    n, first, words, digest = s.chunks(text)
    want_n, want = plain_chunks(text)
    assert n == want_n and list(zip(first.tolist(), words.tolist())) == [(a, b) for a, b, _ in want]
    assert len(set(digest.tolist())) == len({c for _, _, c in want})


def _corpus(seed):
    r = random.Random(seed)
    passages = [_prose(r, 51 + k) for k in range(40)]
    docs, planted = [], {}
    for k, p in enumerate(passages):
        for copy in range(2 + k % 3):
            d = len(docs)
            docs.append((d, f"{_prose(r, r.randint(1, 80))} {p}\n{_prose(r, r.randint(1, 80))}"))
            planted.setdefault(k, []).append(d)
    docs += [(len(docs) + i, _prose(r, 200)) for i in range(40)]
    return docs, planted


def test_planted_passages(spark):
    docs, planted = _corpus(3)
    got = {r["doc_id"]: r for r in s.substring_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    dirty = {d for ds in planted.values() for d in ds}
    assert {d for d, r in got.items() if r["repeated"]} == dirty
    for ds in planted.values():
        for d in ds:
            shared = list(got[d]["shares_with"])
            # chunks at the passage's borders may join a part of its documents: further ids, none of others
            assert (ds[0] if d != ds[0] else ds[-1]) in shared and set(shared) <= set(ds) - {d}
            assert 20 <= got[d]["longest_run"] and (got[d]["n_removed_words"] == 0) == (d == ds[0])


def test_against_plain(spark):
    docs, _ = _corpus(4)
    docs += [(1000, docs[0][1]), (1001, None), (1002, ""), (1003, _prose(random.Random(9), 16))]
    seen = {}
    for d, text in docs:
        for first, n, chunk in plain_chunks(text or "")[1]:
            seen.setdefault(chunk, []).append((d, first, n))
    repeated, removed = {}, {}
    for at in seen.values():
        for d, first, n in at:
            if len(at) > 1:
                repeated.setdefault(d, set()).update(range(first, first + n))
                if (d, first, n) != min(at):
                    removed.setdefault(d, set()).update(range(first, first + n))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for r in s.substring_repeats(frame).collect():
        assert r["n_repeated_words"] == len(repeated.get(r["doc_id"], ()))
        assert r["n_removed_words"] == len(removed.get(r["doc_id"], ()))
    left = {r[0]: r[1] for r in s.dedup_substrings(frame).select("doc_id", "text").collect()}
    for d, text in docs:
        if text is None:
            assert left[d] is None
        else:
            gone = removed.get(d, set())
            assert left[d].split() == [w for k, w in enumerate(text.split()) if k not in gone]


def test_insertion_resists():
    r = random.Random(7)
    text = _prose(r, 400)
    words = text.split()
    changed = " ".join(words[:200] + ["inserted"] + words[200:])
    a, b = ({c for _, _, c in plain_chunks(x)[1]} for x in (text, changed))
    assert len(a - b) <= 16 and len(a & b) > 0.8 * len(a)


def test_odd_rows(spark, odd_documents, no_documents):
    got = {r["doc_id"]: r for r in s.substring_repeats(odd_documents).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, 7, 8, 9, None}
    assert got[5]["repeated"] and got[6]["repeated"] and not got[1]["repeated"] and got[2]["n_words"] == 0
    assert s.substring_repeats(no_documents).count() == 0
    left = s.dedup_substrings(odd_documents)
    assert left.columns == odd_documents.columns and left.count() == odd_documents.count()
    assert s.dedup_substrings(no_documents).count() == 0
