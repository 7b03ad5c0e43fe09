import brute
import pytest

from reelmeter.llm import quality

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_measures(spark):
    texts = [
        "a b c d e a b c d e", "a b c d e f a b c d e f a b c d e", "x " * 50, "a\nb\na\n \n \nb", "# $ | <tag> 100%", "",
        None, "\x0b\x1ctab kept together \x85 é", "one two three four five", "a b c d e x a b c d e", "a a a a a a",
        "😀 ff gg hh ii 😀 ff gg hh ii", "\n".join(["the same line of words here"] * 3),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.measured(docs).collect():
        assert {m: r[m] for m in MEASURES} == brute.quality(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_odd_rows(spark, odd_documents, no_documents):
    found = quality.quality_rules(odd_documents).collect()
    assert len(found) == odd_documents.count()
    texts = {(r["doc_id"], r["text"]) for r in odd_documents.collect()}
    want = sorted((str(d), brute.quality(t)["n_words"], brute.quality(t)["base_failed"]) for d, t in texts)
    assert sorted({(str(r["doc_id"]), r["n_words"], r["base_failed"]) for r in found}) == sorted(set(want))
    assert quality.quality_rules(no_documents).count() == 0


def test_host_verdict(spark):
    good = " ".join(f"word{i}" for i in range(20))
    rows = [(i, "short", "bad.example") for i in range(300)] + [(1000, good, "bad.example")]
    rows += [(2000 + i, good if i % 10 else "short", f"host{i % 7}.example") for i in range(700)]
    rows += [(3000, "short", "small.example"), (3001, good, "small.example"), (4000, good, None)]
    found = quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = {r["doc_id"]: (r["host_rejected"], r["kept"]) for r in found.collect()}
    assert kept[1000] == (True, False)  # passes by itself, its host does not
    assert kept[2001] == (False, True) and kept[2000] == (False, False)
    assert kept[3001] == (False, True)  # two documents say little about a host
    assert kept[4000] == (False, True)


def test_beta_prior(spark):
    """The verdicts against the formulas with plain numbers."""
    rows = [(h, k < f) for h, n, f in (("a", 40, 39), ("b", 50, 5), ("c", 3, 3), ("d", 200, 20)) for k in range(n)]
    found = spark.createDataFrame(rows, "source string, few boolean").selectExpr(
        "source", "if(few, 5, 50) AS n_words", "0 AS word_chars", "0 AS n_symbols", "0 AS n_dup_lines", "0 AS n_repeat_words"
    )
    hosts = {"a": (40, 39), "b": (50, 5), "c": (3, 3), "d": (200, 20)}
    mean = sum(k for _, k in hosts.values()) / sum(n for n, _ in hosts.values())
    spread = sum((k / n - mean) ** 2 for n, k in hosts.values()) / 4 - mean * (1 - mean) * sum(1 / n for n, _ in hosts.values()) / 4
    strength = max(2.0, min(1e4, mean * (1 - mean) / max(spread, 1e-6) - 1))
    want = {h: (k + mean * strength) / (n + strength) > 0.6 for h, (n, k) in hosts.items()}
    got = {r["host"]: r["host_rejected"] for r in quality.host_verdicts(found, "source").collect()}
    assert got == want and want["a"] and not want["b"]


@pytest.mark.parametrize("n", [0, 1, 5, 6, 7])
def test_short_repeats(spark, n):
    text = "w " * n
    got = quality.measured(spark.createDataFrame([(text,)], "text string")).first()["n_repeat_words"]
    assert got == brute.quality(text)["n_repeat_words"]
