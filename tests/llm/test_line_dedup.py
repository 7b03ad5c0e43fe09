import brute
import pytest
from conftest_rows import rows_of

from reelmeter.llm import line_dedup


def plain(docs, min_sites):
    """docs: (id, text, site) with unique ids."""
    sites, first = {}, {}
    for d, text, site in sorted(docs, key=lambda x: (x[0] is None, x[0])):
        for pos, line in enumerate(text.split("\n") if text is not None else ()):
            if brute.SPACED.search(line):
                sites.setdefault(line, set()).update([site] if site is not None else [])
                first.setdefault(line, (d, pos))
    out = {}
    for d, text, _ in docs:
        if text is None:
            out[d,] = (None, 0)
            continue
        lines = text.split("\n")
        gone = [len(sites.get(x, ())) >= min_sites and first[x] != (d, p) for p, x in enumerate(lines)]
        out[d,] = ("\n".join(x for x, g in zip(lines, gone) if not g), sum(gone))
    return out


@pytest.mark.parametrize("min_sites", [1, 2, 3, 8])
def test_against_plain(spark, min_sites):
    docs = [(i, f"own {i}\ncommon\nby {i % 4}\n\nspread {i % 2}\ncommon" + "\n" * (i % 3), f"s{i % 9}") for i in range(40)]
    docs += [(100, None, "s1"), (101, "", "s2"), (102, "common", None), (103, "by 1\n \nby 1", "s1")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = rows_of(line_dedup.dedup_lines(frame, min_sites=min_sites), ["doc_id"], "text", "n_removed")
    assert got == plain(docs, min_sites)


def test_near_threshold_is_exact(spark):
    """Coarse sketches: estimates are far off, lines near the limit are counted all the same."""
    lines = [(n, n, f"site{n}-{k}") for n in range(60, 141, 4) for k in range(n)] * 2
    frame = spark.createDataFrame(lines, "l1 long, l2 long, site string")
    got = sorted(r[0] for r in line_dedup.boilerplate(frame, 100, lg_k=8).collect())
    assert got == [n for n in range(60, 141, 4) if n >= 100]


def test_odd_rows(spark, odd_documents, no_documents):
    found = line_dedup.dedup_lines(odd_documents, min_sites=1)
    assert found.columns == [*odd_documents.columns, "n_removed"] and found.count() == odd_documents.count()
    got = found.select("doc_id", "text").collect()
    assert [r["text"] for r in got if r["doc_id"] == 7] == ["", ""]  # the line stays in document 1
    assert [r["text"] for r in got if r["doc_id"] is None] == ["no id here but some words in a row for once"] * 2
    assert [r["text"] for r in got if r["doc_id"] == 9] == ["same line\n\nother line"]
    assert line_dedup.dedup_lines(no_documents).count() == 0
