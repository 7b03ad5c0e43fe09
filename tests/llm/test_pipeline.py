"""The pipeline from end to end on a small corpus with planted cases."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

CLASHES = ["n_removed", "__hits", "__items", "__score", "__row", "__cut", "__d1", "component_id", "sequence_id"]


def prose(rng, n):
    return " ".join("".join(rng.choice("abdefgiklmnoprstu") for _ in range(rng.randint(3, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    passage = prose(rng, 40)
    rows, labels = [], []

    def add(text, site="s0", doc_id=...):
        rows.append((len(rows) if doc_id is ... else doc_id, text, site))
        return rows[-1][0]

    cases = {"clean": [add(prose(rng, 60), f"s{i % 20}") for i in range(60)]}
    cases["toxic"] = [add(f"{prose(rng, 25)} zzgrumpf vvsnarl zzgrumpf {prose(rng, 25)} vvsnarl", f"s{i % 20}") for i in range(40)]
    copy = prose(rng, 80)
    cases["copies"] = [add(copy) for _ in range(4)] + [add(copy.replace(copy.split()[40], "changed"))]
    cases["leaked"] = [add(f"{prose(rng, 10)} {passage} {prose(rng, 10)}") for _ in range(3)]
    footer = "all rights reserved by this site and its partners"
    cases["lines"] = [add(f"{prose(rng, 50)}\n{footer}", f"site{i}") for i in range(14)]
    cases["empty"] = [add(None), add(""), add(" \n ")]
    cases["long"] = [add(prose(rng, 20_000))]
    twice = (rows[0][0], rows[0][1], rows[0][2])
    rows.append(twice)
    rows.append((None, prose(rng, 50), None))
    labels += [(d, 1, 1) for d in cases["toxic"]] + [(d, 1, 0) for d in cases["clean"]] + [(None, 0, 1), (cases["clean"][0], None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    frame = frame.withColumns({"lang": F.lit("en"), "n_chars": F.char_length("text").cast("long"), **{c: F.lit("mine") for c in CLASHES}})
    folder = str(tmp_path_factory.mktemp("corpus"))
    frame.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, None), (None, "x y z")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, cases, footer


def stages(spark, folder, tmp_path):
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = out[name] = spark.read.parquet(str(tmp_path / name))
    return out


def test_stages(spark, corpus, tmp_path):
    folder, cases, footer = corpus
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    out = stages(spark, folder, tmp_path)
    ids = {name: [r[0] for r in frame.select("doc_id").collect()] for name, frame in out.items()}
    for name in list(out)[:-1]:
        assert out[name].columns == documents.columns
        assert all(r[c] == "mine" for r in out[name].select(*CLASHES).collect() for c in CLASHES)
    held_out = [d for d in cases["toxic"] if zlib.crc32(str(d).encode()) % 4 == 2]
    assert held_out and not set(cases["toxic"]) & set(ids["toxicity"])
    for kept in ("clean", "leaked", "lines", "copies", "empty", "long"):
        assert set(cases[kept]) <= set(ids["toxicity"]), kept
    lines = {r.doc_id: r.text for r in out["line_dedup"].collect()}
    assert sum(footer in lines[d] for d in cases["lines"]) == 1 and len(ids["line_dedup"]) == len(ids["toxicity"])
    assert len(set(cases["copies"]) & set(ids["jaccard_join"])) == 1
    assert ids["jaccard_join"].count(cases["clean"][0]) == 1  # the repeated row
    assert set(cases["clean"]) | set(cases["leaked"]) | set(cases["lines"]) | set(cases["empty"]) <= set(ids["jaccard_join"])
    assert None in ids["jaccard_join"]
    assert not set(cases["leaked"]) & set(ids["decontamination"])
    assert sorted(map(str, set(ids["jaccard_join"]) - set(cases["leaked"]))) == sorted(map(str, ids["decontamination"]))
    assert set(ids["packing"]) == set(ids["decontamination"])
    used = out["packing"].groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("pieces"))
    assert used.agg(F.max("n")).first()[0] <= 4096


def test_run_is_the_stages(spark, corpus, tmp_path):
    folder, _, _ = corpus
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    want = stages(spark, folder, tmp_path)["packing"].select(*columns)
    got = corpus_pipeline.run(spark, folder).select(*columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_empty_tables(spark, corpus, tmp_path):
    folder, _, _ = corpus
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").where("false").write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
