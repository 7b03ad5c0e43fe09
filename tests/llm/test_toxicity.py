import math
import random
import zlib

import pytest

from reelmeter.llm import toxicity as t


def test_fold():
    assert t.fold("The ІDІОТ").split() == ["the", "idiot"]
    assert t.fold("1d10t $cum tr@sh ＬＯＳＥＲ mo­ron").split() == ["idiot", "scum", "trash", "loser", "moron"]
    assert t.fold("trash### ***clown&&& a$$$ b").split() == ["trash", "clown", "a", "b"]
    assert t.fold(None) == "  " and t.fold("Çà É").split() == ["çà", "é"]


def test_exceptions_and_length():
    m = t.Lexicon({}, 0, 0).matcher()
    assert m.score("take out the trash can") == m.score("") == m.score(None)
    assert m.score("you idiot, you trash") > m.score("you idiot, you trash " + "and more words " * 400) > m.score("fine")
    assert m.score("idiotic") == m.score("")


def test_left_out_weights():
    m = t.Lexicon({" bad ": (3, 0), " worse ": (40, 0)}, 100, 900).matcher()
    assert m.features("bad")[3] == t.weight(3, 0, 100, 900) > 0
    assert m.features("bad", 1)[3] == 0  # one toxic document less is too few
    assert m.features("worse", 1)[3] == t.weight(39, 0, 100, 900)


def test_counted_is_what_is_found():
    """An entry is counted in just the documents in which the automaton finds it, so leaving one out stays sound."""
    texts = ["cat", "cats", "category of cat", "concat ca", "x" * 40 + " cat"]
    offered = [t.entries_of(t.fold(x)) for x in texts]
    every = set().union(*offered)
    automaton = t.Lexicon({e: (5, 0) for e in every}, 10, 10).matcher().automaton
    for text, own in zip(texts, offered):
        assert {e for _, e in automaton.iter(t.fold(text))} & every == own
    clean = t.Lexicon({" cat": (5, 1)}, 10, 10).matcher()
    assert clean.features("cat", 0)[3] >= clean.features("cat")[3] >= 0


def _corpus(spark, n=1500, seed=0):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("aeioulmnrst") for _ in range(r.randint(3, 8))) for _ in range(500)]
    slurs = [f"grub{x}" for x in ("la", "no", "ti", "ze")] + ["vexen"]
    docs, labels = [], []
    for i in range(n):
        words = [r.choice(vocabulary) for _ in range(r.randint(5, 120))]
        toxic = int(r.random() < 0.15)
        if toxic:
            for _ in range(r.randint(2, 5)):
                words.insert(r.randrange(len(words)), r.choice(slurs))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return (
        docs,
        spark.createDataFrame(docs, "doc_id long, text string"),
        {i: y for i, _, y in labels},
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_held_out_accuracy(spark):
    docs, frame, truth, labels = _corpus(spark)
    rows = t.toxicity(frame, labels).collect()
    assert {r["doc_id"]: r["held_out"] for r in rows} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, _ in docs}
    held = [r for r in rows if r["held_out"]]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert right >= 0.98 * len(held)
    kept = {r["doc_id"] for r in t.drop_toxic(frame, labels).collect()}
    assert kept == {r["doc_id"] for r in rows if r["predicted"] == 0}


def test_held_out_labels_do_not_matter(spark):
    _, frame, _, labels = _corpus(spark, 300)
    flipped = labels.selectExpr("doc_id", "quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - toxic, toxic) AS toxic")
    a, b = ({r["doc_id"]: round(r["score"], 9) for r in t.toxicity(frame, x).collect()} for x in (labels, flipped))
    assert a == b


@pytest.mark.parametrize("kind", ["none", "nulls", "one"])
def test_few_labels(spark, odd_documents, no_documents, kind):
    rows = {"none": [], "nulls": [(None, 1, 1), (1, 1, None)], "one": [(1, 1, 1), (1, 1, 0), (5, 0, 0)]}[kind]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    found = t.toxicity(odd_documents, labels).collect()
    assert len(found) == odd_documents.count() and not any(r["held_out"] for r in found if r["doc_id"] is None)
    assert t.toxicity(no_documents, labels).count() == 0
    assert t.drop_toxic(odd_documents, labels).columns == odd_documents.columns


def plain_features(lexicon, text):
    """Every entry looked for at every place, without an automaton."""
    folded = t.fold(text)
    entries = set(lexicon.counts) | lexicon.seeds
    places = lambda x: [i for i in range(len(folded)) if folded.startswith(x, i)]
    found = {}
    for entry in entries:
        w = t.weight(*lexicon.counts.get(entry, (0, 0)), lexicon.toxic, lexicon.clean, entry in lexicon.seeds)
        for i in places(entry):
            if w > 0:
                found[i] = max(w, found.get(i, 0.0))
    for phrase in lexicon.harmless:
        for a in places(f" {phrase} "):
            for i in range(a, a + len(phrase) + 1):  # the blank behind it begins what follows
                found.pop(i, None)
    total, words = sum(found.values()), len(folded.split()) or 1
    return [1.0, math.log1p(total), math.log1p(100 * total / words), max(found.values(), default=0.0), math.log1p(len(found))]


@pytest.mark.parametrize("seed", range(5))
def test_automaton_against_plain_search(seed):
    rng = random.Random(seed)
    words = ["stupid", "stupidity", "stu", "trash", "can", "clown", "fish", "graf", "grafter", "idiot", "1d10t", "ok", "trаsh", "ﬁne", ""]
    counts = {f" {w} ": (rng.randint(0, 30), rng.randint(0, 5)) for w in ("stupid", "graf", "ok", "can")}
    counts |= {f" {w}": (rng.randint(0, 30), rng.randint(0, 5)) for w in ("stu", "stup", "gra", "graf", "tra", "idi")}
    lexicon = t.Lexicon(counts, 40, 400)
    matcher = lexicon.matcher()
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(40)] + [None, "", "trash can", "x" * 50_000 + " idiot"]
    for text in texts:
        want = plain_features(lexicon, text)
        assert matcher.features(text) == pytest.approx(want), text
        z = sum(a * b for a, b in zip(want, lexicon.curve))
        assert matcher.score(text) == pytest.approx(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
