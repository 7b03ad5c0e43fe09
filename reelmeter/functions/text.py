"""String rules for titles, ids, labels and answers, as column expressions."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelmeter.fixed_values import OTHER_BUCKET, PAD, SUBJECT_BUCKETS
from reelmeter.functions.arithmetic import whole


def clean_title(title: Column) -> Column:
    """Blank, slash, colon and dot become underscores."""
    return F.translate(title, " /:.", "____")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def scene_id(path: Column, clean: Column) -> Column:
    """File name up to its first dot, then the cleaned title."""
    return F.concat_ws("_", F.split(base_name(path), r"\.")[0], clean)


def url_video_id(url: Column, marker: str = "?v=") -> Column:
    """Text after the last marker; the whole string when there is none."""
    return F.element_at(F.split(url, re.escape(marker)), -1)


def strip_pad(answer: Column) -> Column:
    """Values of an answer map without padding; values without padding stay untrimmed."""
    return F.transform_values(
        answer,
        lambda _, v: F.when(F.contains(v, F.lit(PAD)), trimmed(F.replace(v, F.lit(PAD), F.lit(""))))
        .otherwise(v),
    )


def trimmed(text: Column) -> Column:
    """Text without leading and trailing whitespace of any kind."""
    return F.regexp_replace(text, r"^[\p{IsWhite_Space}\x1C-\x1F]+|[\p{IsWhite_Space}\x1C-\x1F]+$", "")


def bucket(label: Column, buckets=SUBJECT_BUCKETS, other: str = OTHER_BUCKET) -> Column:
    """First bucket one of whose words occurs in the lower-cased label."""
    lowered = F.lower(label)
    chain = F
    for name, words in buckets:
        chain = chain.when(reduce(or_, [F.contains(lowered, F.lit(w)) for w in words]), F.lit(name))
    return chain.otherwise(F.lit(other))


def clock_label(second: Column) -> Column:
    """``frame_MM:SS.png`` of a whole second; minutes run past 59."""
    return F.format_string(
        "frame_%02d:%02d.png", whole(second, 60), F.pmod(second, F.lit(60))
    )
