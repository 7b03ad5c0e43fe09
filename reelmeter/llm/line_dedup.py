"""Cross-site boilerplate lines, in DataFrame functions only.

A line that many distinct sites carry is boilerplate. Sites per line are counted
with HyperLogLog sketches that merge by aggregation; lines whose estimate is near
the limit are counted exactly. One occurrence of a boilerplate line stays, the
first in order of documents, so nothing vanishes from the corpus altogether.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmeter.llm.common import SPACE, discard, free_name, kept_on_disk

#: Distinct sites from which on a line is boilerplate.
MIN_SITES = 10
#: log2 of the buckets of a sketch; its standard error is about 1.04 / sqrt(2 ** LG_K).
LG_K = 10


def _hash128(name: str, *columns: Column) -> list[Column]:
    """Two independent 64-bit hashes; nulls count as such."""
    return [
        F.xxhash64(F.lit(seed), *columns).alias(f"{name}{k}") for k, seed in enumerate(("first", "second"), 1)
    ]


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """(l1, l2) of the lines of (l1, l2, site) that at least ``min_sites`` sites carry; null sites do not count.

    Estimates further than six standard errors from the limit are believed, the
    lines between are counted exactly over all their rows.
    """
    margin = min_sites * 6 * 1.04 / 2 ** (lg_k / 2)
    sited = lines.where("site IS NOT NULL")
    estimates = sited.groupBy("l1", "l2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites")
    )
    # few lines are near the limit or beyond it; what both branches read is stored
    likely, _ = kept_on_disk(estimates.where(F.col("sites") >= min_sites - margin), "likely-boilerplate")
    surely = likely.where(F.col("sites") > min_sites + margin).select("l1", "l2")
    exact = (
        sited.join(likely.where(F.col("sites") <= min_sites + margin), ["l1", "l2"], "left_semi")
        .select("l1", "l2", "site")
        .distinct()
        .groupBy("l1", "l2")
        .agg(F.count(F.lit(1)).alias("sites"))
    )
    return surely.unionByName(exact.where(F.col("sites") >= min_sites).select("l1", "l2"))


def dedup_lines(
    docs: DataFrame, site: str = "source", doc_id: str = "doc_id", min_sites: int = MIN_SITES, lg_k: int = LG_K,
    count: str | None = "n_removed",
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and ``count``, the lines taken out (None: no such column).

    Lines are the parts between newlines; parts without a word are never
    boilerplate. Of a boilerplate line the first occurrence stays, by (doc_id, place
    in the text). The other lines keep their order and their newlines. Null texts
    stay null, null doc_ids come last in the order, rows equal in doc_id and text
    keep the same lines. All columns are kept, whatever their names; where one is called as
    ``count``, the added one has underscores behind its name. No row is dropped, also when its text
    becomes empty. Texts may be of any length; an empty table gives an empty one.

    Texts are read once to hash their lines and once more to be cut; what is
    grouped and joined are hashes of lines and of rows, so a hot site, line or
    document is only a count that was combined before the shuffle.
    """
    text, key = F.col("text"), _hash128("d", F.col(doc_id), F.col("text"))
    unfolded = docs.where("text IS NOT NULL").select(
        *key, F.col(doc_id).alias("id"), F.col(site).alias("site"), F.posexplode(F.split(text, "\n")).alias("pos", "line")
    )
    hashed = unfolded.where(F.col("line").rlike(f"[^{SPACE}]")).select(
        "d1", "d2", "id", "pos", "site", *_hash128("l", F.col("line"))
    )
    lines, lines_path = kept_on_disk(hashed, "lines")
    found, found_path = kept_on_disk(boilerplate(lines, min_sites, lg_k), "boilerplate")
    places = lines.join(found, ["l1", "l2"])
    order = F.struct(F.col("id").isNull(), "id", "d1", "d2", "pos")
    firsts = places.groupBy("l1", "l2").agg(F.min(order).alias("first"))
    cuts = (
        places.join(firsts, ["l1", "l2"])
        .where(F.struct(F.col("id").isNull(), "id", "d1", "d2", "pos") != F.col("first"))
        .groupBy("d1", "d2")
        .agg(F.collect_set("pos").alias("cut"))
    )
    # places of what is taken out are few against all lines, which are not needed any more
    cuts, _ = kept_on_disk(cuts, "cuts")
    discard(docs.sparkSession, lines_path, found_path)
    d1, d2, c1, c2, taken = (free_name(docs.columns, n) for n in ("__d1", "__d2", "__c1", "__c2", "__cut"))
    keyed = docs.withColumns({d1: key[0], d2: key[1]})
    joined = keyed.join(
        cuts.select(F.col("d1").alias(c1), F.col("d2").alias(c2), F.col("cut").alias(taken)),
        (F.col(d1) == F.col(c1)) & (F.col(d2) == F.col(c2)),
        "left",
    )
    left = F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(F.col(taken), i))
    cut = F.when(F.col(taken).isNull(), text).otherwise(F.array_join(left, "\n"))
    others = [F.col(f"`{c}`") for c in docs.columns]
    removed = F.when(F.col(taken).isNull(), 0).otherwise(F.size(taken)).cast("long")
    columns = [cut.alias(c) if c == "text" else o for c, o in zip(docs.columns, others)]
    return joined.select(*columns, *([removed.alias(free_name(docs.columns, count))] if count else []))
