import random

import brute
import pytest
from conftest_rows import rows_of

from reelmeter.llm import decontamination as d

NAMES = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


@pytest.mark.parametrize("seed", range(20))
def test_search(seed):
    r = random.Random(seed)
    words = [bytes([97 + r.randrange(4)]) for _ in range(200)]
    patterns = {}
    for _ in range(r.randint(1, 12)):
        at, n = r.randrange(190), r.choice([1, 2, 3, 5, 8, 13])
        p = tuple(words[at : at + n]) if r.random() < 0.7 else tuple(r.choice([b"a", b"b", b"e"]) for _ in range(n))
        patterns[p] = ["x"]
    got = sorted(d.WuManber(patterns).occurrences(words))
    want = sorted((i, p) for p in patterns for i in range(len(words) - len(p) + 1) if tuple(words[i : i + len(p)]) == p)
    assert got == want


def _tables(spark):
    long = [f"Item{i % 7} word{i}" for i in range(20)]
    items = [("9", " ".join(long)), ("10", "Short one!"), ("11", None), ("12", "..."), (None, "never used"), ("13", "SHORT-one")]
    docs = [
        (1, "x " * 5 + " ".join(long) + " y"), (2, "a short, ONE"), (3, "short"), (4, None), (5, ""), (6, "short one " * 3 + "z " * 90),
        (7, "z " * 200 + "short one"), (8, " ".join(long[:6])), (9, " ".join(long[3:12]).upper()), (9, "short one"), (10, "shört one é"),
    ]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_against_plain(spark, block_bytes, monkeypatch):
    monkeypatch.setattr(d, "BLOCK_BYTES", block_bytes)
    docs, items, frame, benchmark = _tables(spark)
    want = sorted((i, *brute.decontamination([(i, t)], [x for x in items if x[0]])[i]) for i, t in docs)
    found = d.find_benchmark(frame, benchmark, 13, block_bytes).mapInArrow(d._verdicts, d._RESULT)
    assert sorted(map(tuple, found.collect())) == want
    assert {r[0] for r in want if r[-1]} >= {1, 2, 9}
    assert sorted(r["doc_id"] for r in d.drop_contaminated(frame, benchmark).collect()) == sorted(r[0] for r in want if not r[-1])


def test_odd_rows(spark, odd_documents, no_documents):
    benchmark = spark.createDataFrame([("1", "five six seven")], "item_id string, text string")
    got = rows_of(d.decontaminate(odd_documents, benchmark), ["doc_id"], "n_words", "n_hit", "contaminated")
    assert got[1,] == got[7,] == (12, 3, True) and got[2,] == got[3,] == (0, 0, False) and got[5,] == (60000, 0, False)
    assert d.decontaminate(odd_documents, benchmark).count() == odd_documents.count()
    assert d.decontaminate(no_documents, benchmark).count() == 0
    assert d.decontaminate(odd_documents, benchmark.where("false")).where("contaminated").count() == 0
    left = d.drop_contaminated(odd_documents, benchmark)
    assert left.columns == odd_documents.columns and left.count() == odd_documents.count() - 3
