"""URL filters: host-suffix and path-prefix expressions joined with rules on short hash prefixes.

A rule is a host and the beginning of a path; it fits the host and its
subdomains where the path begins so. Each URL is expanded into the expressions
that could be rules, that is the last k labels of its host with the first m
characters of its path, for the few pairs (k, m) that rules really have. The
first 32 bits of an expression's SHA-256 are equi-joined with those of the
rules, the full digest confirms, and the longest rule wins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmeter.llm.common import kept_on_disk
from reelmeter.session import at_most

#: Rules that may be broadcast: rows, and bytes as text.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20
#: Pairs of labels and path length that rules may have; each can cost an expression for every URL.
MAX_SHAPES = 4_096
#: Hex digits of a digest that are joined on.
SHORT = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` is allow or block."""

    host: str
    path: str
    verdict: str


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """Rules written out by hand as the table that ``filter_urls`` takes: host, path, verdict."""
    return spark.createDataFrame([(r.host, r.path, r.verdict) for r in rules], "host string, path string, verdict string")


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def _digest(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def prepared(rules: DataFrame) -> DataFrame:
    """One row per distinct expression: short, digest, rule, verdict, labels, length.

    Hosts are lower-cased (A-Z). Of equal rules with different verdicts, block holds. Rules with a
    null or empty host, one with ``/``, ``?`` or ``#``, or another verdict than allow and block, are refused when read; a null path is empty.
    """
    host = F.translate("host", _UPPER, _LOWER)
    sound = F.coalesce(F.col("host").rlike(r"\A[^/?#]+\z"), F.lit(False)) & F.coalesce(F.col("verdict").isin("allow", "block"), F.lit(False))
    checked = F.when(sound, host).otherwise(F.raise_error(F.lit("a rule needs a plain host, and allow or block")))
    rows = rules.select(checked.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    one = rows.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block is the larger word
    rule = F.concat("host", "path")
    digest = _digest(F.concat_ws("/", "host", "path"))  # hosts have no slash, so this is unique
    return one.select(
        F.substring(digest, 1, SHORT).alias("short"), digest.alias("digest"), rule.alias("rule"), "verdict",
        _labels(F.col("host")).alias("labels"), F.char_length("path").alias("length"),
    )


def expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Digests of the expressions of a URL, one for every shape (labels, path characters) that it has."""
    if not shapes:
        return F.array().cast("array<string>")
    known = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(m).alias("m")) for k, m in shapes])
    fits = F.filter(known, lambda s: (s["k"] <= _labels(host)) & (s["m"] <= F.char_length(path)))

    def one(s: Column) -> Column:
        suffix = F.call_function("substring_index", host, F.lit("."), -s["k"])
        return _digest(F.concat_ws("/", suffix, F.substring(path, F.lit(1), s["m"])))

    return F.transform(fits, one)


def _matches(rows: DataFrame, rules: DataFrame, broadcast: bool) -> DataFrame:
    """``rows`` (with short and full digest of an expression) and ``__found``, the rule whose full digest is the same."""
    entry = F.struct(
        "digest", F.struct(F.char_length("rule").alias("size"), "labels", "verdict", "rule").alias("found")
    )
    # rules of one short digest come together, so a row meets one row at most
    right = rules.groupBy(F.col("short").alias("__short")).agg(F.collect_list(entry).alias("__rules"))
    joined = rows.join(F.broadcast(right) if broadcast else right, F.col("__s") == F.col("__short"), "left")
    confirmed = F.filter("__rules", lambda r: r["digest"] == F.col("__d"))
    return joined.withColumn("__found", F.get(confirmed, 0)["found"]).drop("__short", "__rules")


def _dealt(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """The join with more rules than may be broadcast.

    Prefixes that hold more than a 1,000th of all expressions (fewer than 1,000 of
    them, whatever the data) take their rules by broadcast; only the others are
    shuffled by prefix, where none is hot.
    """
    counts = rows.where("__s IS NOT NULL").groupBy("__s").agg(F.count(F.lit(1)).alias("n"))
    counts, _ = kept_on_disk(counts, "url-prefixes")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = [r[0] for r in counts.where(F.col("n") * 1000 > total).select("__s").collect()]
    is_hot = F.coalesce(F.col("__s").isin(hot), F.lit(False)) if hot else F.lit(False)
    in_hot = F.col("short").isin(hot) if hot else F.lit(False)
    few = rules.where(in_hot)
    if not at_most(few, BROADCAST_ROWS, BROADCAST_BYTES):  # that many rules of equal prefixes are not found by chance
        raise ValueError("rules that collide in a short digest")
    return _matches(rows.where(is_hot), few, True).unionByName(_matches(rows.where(~is_hot), rules.where(~in_hot), False))


def filter_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", keep: tuple[str, ...] = ("page_id",), default: str = "allow"
) -> DataFrame:
    """Columns ``keep``, then host, path, rule and verdict of every row of ``pages``.

    ``rules`` has host, path and verdict (allow or block). A rule fits when the URL's host is
    the rule's or ends with a dot and the rule's, and its path begins with the rule's, character
    by character. Of several, the longest text (host and path) wins, then the one with more labels,
    then block. URLs that no rule fits have a null rule and the verdict ``default``.

    A null URL, or one without ``://``, has an empty host and path and so no rule. Repeated rows
    give repeated results, an empty table an empty one, and without rules all rows get ``default``.
    Columns that are not named are left out and may have any name. URLs may be of any length: only
    beginnings and endings as long as some rule's are hashed.

    All expressions of a row arise in one task, so the longest rule of each row is found before
    anything is shuffled and a row, not its expressions, moves; equal rows move once with their number.
    """
    spark = pages.sparkSession
    table, _ = kept_on_disk(prepared(rules), "url-rules")
    shapes = table.select("labels", "length").distinct()
    if not at_most(shapes, MAX_SHAPES, MAX_SHAPES * 64):
        raise ValueError(f"rules have more than {MAX_SHAPES} shapes")
    shapes = sorted((r[0], r[1]) for r in shapes.collect())
    names = [f"__k{i}" for i in range(len(keep))]
    rows = pages.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)],
        url_host(F.col(f"`{url}`")).alias("__host"), url_path(F.col(f"`{url}`")).alias("__path"),
    )
    found = rows.select("*", F.posexplode_outer(expressions(F.col("__host"), F.col("__path"), shapes)).alias("__i", "__d"))
    found = found.withColumn("__s", F.substring("__d", 1, SHORT))
    small = at_most(table, BROADCAST_ROWS, BROADCAST_BYTES)
    matched = _matches(found, table, True) if small else _dealt(found, table)
    # a row that is there twice has its first expression twice
    copies = F.sum(F.when(F.coalesce("__i", F.lit(0)) == 0, 1).otherwise(0)).cast("int")
    best = matched.groupBy(*names, "__host", "__path").agg(F.max("__found").alias("best"), copies.alias("copies"))
    each = best.select("*", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    return each.select(
        *[F.col(n).alias(c) for c, n in zip(keep, names)],
        F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
