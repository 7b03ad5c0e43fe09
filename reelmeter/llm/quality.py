"""Host-level quality rules, in DataFrame functions only.

Every document is measured by itself and fails or passes a few rules. Failures
are counted per host, each host's rates are shrunk towards the rate of all hosts
by a beta prior that is fitted to the hosts themselves, and the verdict on a
host goes back to its documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmeter.llm.common import SPACE, kept_on_disk

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class HostRules:
    """A host is rejected when a shrunk failure rate is above its rule's limit.

    ``rules`` are SQL conditions on the measures of a document. Limits are far
    above what a host with a few bad documents reaches: its good documents stay.
    """

    rules: tuple[tuple[str, str, float], ...] = (
        ("few_words", "n_words < 10", 0.6),
        ("repetition", "100 * n_repeat_words > 20 * n_words", 0.6),
        ("symbols", "10 * n_symbols > word_chars", 0.6),
        ("dup_lines", "n_dup_lines > 0 AND 5 * n_dup_lines > n_words", 0.6),
    )


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` refers to it."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words in windows of five that occur twice or more in the text.

    Hashes of the windows show quickly that most texts repeat nothing. In the
    others, windows are sorted as strings, equal neighbours are marked, and the
    marked starts, in order, cover up to five words each.
    """

    def window_hash(w: Column, i: Column) -> Column:
        return F.xxhash64(*[F.get(w, i + k) for k in range(5)])

    def window(w: Column, i: Column) -> Column:
        return F.concat_ws(" ", *[F.get(w, i + k) for k in range(5)])

    def starts(w: Column) -> Column:
        return F.sequence(F.lit(0), F.size(w) - 5)

    def marked(windows: Column) -> Column:
        """Starts of repeated windows; ``windows`` are (text, start) in order."""
        n = F.size(windows)
        numbered = F.sequence(F.lit(0), n - 1)

        def same(i: Column, j: Column) -> Column:
            return F.coalesce(F.get(windows, i)["w"] == F.get(windows, j)["w"], F.lit(False))

        hit = F.filter(numbered, lambda i: same(i, i - 1) | same(i, i + 1))
        return F.array_sort(F.transform(hit, lambda i: F.get(windows, i)["i"]))

    def covered(at: Column) -> Column:
        nothing = F.struct(F.lit(0).alias("n"), F.lit(-5).alias("last"))
        return F.aggregate(
            at,
            nothing,
            lambda s, i: F.struct((s["n"] + F.least(F.lit(5), i - s["last"])).alias("n"), i.alias("last")),
            lambda s: s["n"],
        )

    def exact(w: Column) -> Column:
        rows = F.transform(starts(w), lambda i: F.struct(window(w, i).alias("w"), i.alias("i")))
        return _let(F.sort_array(rows), lambda s: _let(marked(s), covered))

    def counted(w: Column) -> Column:
        hashes = F.transform(starts(w), lambda i: window_hash(w, i))
        repeats = _let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
        return F.when(F.size(w) < 6, 0).when(repeats, exact(w)).otherwise(0)

    return _let(words, counted)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures of ``text`` and ``base_failed``; a null text is measured as empty."""
    value = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(value, f"[{SPACE}]+"), lambda w: w != "")
    lines = F.filter(F.split(value, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    symbols = F.octet_length(value) - F.octet_length(F.regexp_replace(value, r"[#*$%&|<>]", ""))

    def of(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            symbols.cast("long").alias("n_symbols"),
            _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
        )

    found = docs.withColumn("__m", _let(words, of))
    found = found.withColumns({m: F.col("__m")[m] for m in MEASURES}).drop("__m")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.withColumn("base_failed", failed)


def host_verdicts(found: DataFrame, host: str, rules: HostRules = HostRules()) -> DataFrame:
    """(host, host_docs, host_rejected): one row per non-null host of measured documents.

    The prior is Beta(a, b) by the method of moments over the hosts' failure
    rates: the mean of all, and the spread that is left when the sampling noise
    of each host's own count is taken off. Hosts that agree give a strong prior,
    so that a host with few documents is judged like all others.
    """
    counts = found.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host"))
    hosts = counts.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.expr(rule).cast("long")).alias(f"k_{name}") for name, rule, _ in rules.rules],
    )
    names = [name for name, _, _ in rules.rules]
    moments = hosts.agg(
        *[F.sum(f"k_{x}").alias(f"k_{x}") for x in names],
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("hosts"),
        F.sum(1 / F.col("n")).alias("inverse"),
        *[F.sum((F.col(f"k_{x}") / F.col("n")) ** 2).alias(f"s_{x}") for x in names],
        *[F.sum(F.col(f"k_{x}") / F.col("n")).alias(f"r_{x}") for x in names],
    )
    priors = []
    for x in names:
        mean = F.col(f"k_{x}") / F.col("n")
        around = F.col(f"s_{x}") / F.col("hosts") - 2 * mean * F.col(f"r_{x}") / F.col("hosts") + mean**2
        noise = mean * (1 - mean) * F.col("inverse") / F.col("hosts")
        spread = F.greatest(around - noise, F.lit(1e-6))
        strength = F.greatest(F.lit(2.0), F.least(F.lit(1e4), mean * (1 - mean) / spread - 1))
        priors += [(mean * strength).alias(f"a_{x}"), strength.alias(f"t_{x}")]
    # one row, so joining it to the hosts needs no key
    judged = hosts.join(F.broadcast(moments.select(*priors)))
    bad = F.lit(False)
    for name, _, limit in rules.rules:
        bad |= (F.col(f"k_{name}") + F.col(f"a_{name}")) / (F.col("n") + F.col(f"t_{name}")) > limit
    return judged.select("host", F.col("n").alias("host_docs"), bad.alias("host_rejected"))


def quality_rules(
    docs: DataFrame, host: str = "source", keep: tuple[str, ...] = ("doc_id",), rules: HostRules = HostRules()
) -> DataFrame:
    """Measures and verdict of every row of ``docs``: columns ``keep``, then measures, base_failed, host_rejected, kept.

    A row is kept when it passes the base rules and its host is not rejected.
    Texts are measured whole, however long; a null text is measured as empty. A rate that equals its limit passes.
    Rows without a host are judged by themselves. Repeated rows count as often as
    they occur; an empty table gives an empty one; columns that are not named are
    left out, and so may have any names. Texts are read once: what is joined are
    the measures, and counts per host are combined before they are shuffled.
    """
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{host}`").alias("__host"), "text")
    found, _ = kept_on_disk(measured(source).drop("text"), "quality")
    verdicts = host_verdicts(found, "__host", rules)
    joined = found.join(verdicts, found["__host"] == verdicts["host"], "left")
    rejected = F.coalesce(F.col("host_rejected"), F.lit(False))
    return joined.select(
        *[F.col(f"`{c}`") for c in keep], *MEASURES, "base_failed", rejected.alias("host_rejected"),
        (~F.col("base_failed") & ~rejected).alias("kept"),
    )
