import random

import brute
import pytest

from reelmeter.llm import jaccard_join
from reelmeter.llm.components import components


def _texts(seed, families=6, members=12, words=60):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(families):
        base = [r.choice(vocabulary) for _ in range(words)]
        for _ in range(members):
            text = list(base)
            for _ in range(r.randint(0, 4)):
                text[r.randrange(len(text))] = r.choice(vocabulary)
            out.append(" ".join(text))
    out += ["", "a", "A", "a b", "b a", None, "hot line of words here"] + [f"hot line of words here {i}" for i in range(5)]
    return list(enumerate(out))


@pytest.mark.parametrize("seed,size,percent", [(1, 3, 90), (2, 3, 80), (3, 5, 80), (4, 2, 70)])
def test_against_all_pairs(spark, seed, size, percent):
    texts = _texts(seed)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    sets = {d: brute.shingles(t, size) for d, t in texts}
    want = brute.components_of(sets, percent)
    got = {r[0]: (r[1], r[2]) for r in jaccard_join.similar_documents(docs, size, percent).collect()}
    assert got == {d: (len(sets[d]), want[d]) for d in sets}


def test_groups_are_dealt(spark, monkeypatch):
    """Large groups of near copies are split, and no link between the parts is lost."""
    monkeypatch.setattr(jaccard_join, "GROUP_DOCS", 3)
    texts = _texts(5, families=2, members=40)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = brute.similar_groups(texts)
    assert {r[0]: (r[1], r[2]) for r in jaccard_join.similar_documents(docs, 3, 90).collect()} == want


def test_odd_rows(spark, odd_documents, no_documents):
    found = jaccard_join.similar_documents(odd_documents, 3, 90)
    got = sorted(map(tuple, found.collect()), key=str)
    assert len(got) == odd_documents.count()
    by = {r[0]: r[2] for r in got}
    assert by[1] == by[7] == 1 and by[5] == by[6] == 5 and by[2] == 2 and by[3] == 3 and by[None] is None
    assert jaccard_join.similar_documents(no_documents, 3, 90).count() == 0
    left = jaccard_join.drop_similar(odd_documents, 3, 90)
    assert left.columns == odd_documents.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted("1 2 3 4 5 8 9 None None".split())
    assert jaccard_join.drop_similar(no_documents).count() == 0


def test_rows_that_share_an_id_stay_apart(spark):
    def text(word, n=12):
        return " ".join(f"{word}{i}" for i in range(n))

    rows = [
        (1, text("a"), "x"), (2, text("a"), "y"), (2, text("b"), "z"), (3, text("c"), "x"), (3, text("d"), "y"),
        (4, text("c"), "z"), (5, text("b"), "x"), (6, None, "x"), (6, None, "y"), (6, text("e"), "z"), (6, text("e"), "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    left = jaccard_join.drop_similar(docs, 3, 90)
    assert left.columns == docs.columns
    want = [(1, text("a")), (2, text("b")), (3, text("c")), (3, text("d")), (6, None), (6, text("e"))]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(want, key=str)
    long = spark.createDataFrame([(8, text("n", 40)), (7, text("n", 41)), (8, text("m"))], "doc_id long, text string")
    assert {(r.doc_id, r.text) for r in jaccard_join.drop_similar(long, 3, 90).collect()} == {(7, text("n", 41)), (8, text("m"))}


def test_components(spark):
    r = random.Random(0)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 160)] + [(200, 200)]
    links += [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(60)]
    want = brute.components_of_links(links)
    got = {a: b for a, b in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {k: v for k, v in want.items() if k in got} and set(want) - set(got) <= {u for u, v in links if u == v}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
