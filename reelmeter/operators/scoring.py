"""Batched model calls as Spark stages, with failures kept as rows."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmeter.session import few_rows


# The model of this Python worker process, under the call it was loaded for.
_loaded: dict[str, Any] = {}


def _worker_model(call: str, load_fn: Callable[[], Any]) -> Any:
    """Load on the first task of a worker process; later tasks of the same call reuse it."""
    if call not in _loaded:
        _loaded.clear()
        _loaded[call] = load_fn()
    return _loaded[call]


_OUTPUT_ROWS = 1000  # outputs are small: hand them back to Spark in larger pieces


def _rebatched(frames: Iterable[pd.DataFrame], size: int) -> Iterable[pd.DataFrame]:
    """The same rows ``size`` at a time, whatever number Arrow delivers."""
    held, n = [], 0
    for pdf in frames:
        start = 0
        while n + len(pdf) - start >= size:
            stop = start + size - n
            piece = pdf.iloc[start:stop]
            yield pd.concat([*held, piece], ignore_index=True) if held else piece.reset_index(drop=True)
            held, n, start = [], 0, stop
        if start < len(pdf):
            held.append(pdf.iloc[start:])
            n += len(pdf) - start
    if held:
        yield pd.concat(held, ignore_index=True)


def _output(names: Sequence[str], done: list[tuple]) -> pd.DataFrame:
    """One frame of the outputs of several batches."""
    sizes = [len(outputs) for _, outputs, _, _, _ in done]
    columns = {name: np.concatenate([keys[i] for keys, *_ in done]) for i, name in enumerate(names)}
    out = pd.DataFrame(columns)
    out["result"] = pd.Series([x for _, outputs, _, _, _ in done for x in outputs], dtype=object)
    out["error"] = pd.Series(np.repeat(np.array([d[2] for d in done], dtype=object), sizes), dtype=object)
    for column, i in (("started", 3), ("finished", 4)):
        stamps = np.repeat(np.array([d[i] for d in done], dtype="int64"), sizes)
        out[column] = pd.to_datetime(stamps, unit="us", utc=True)
    return out


def _now_us() -> int:
    return time.time_ns() // 1000


def score_batches(
    items: DataFrame,
    load_fn: Callable[[], Any],
    infer_fn: Callable[[Any, pd.DataFrame], Iterable],
    result_type: T.DataType | str,
    keys: Sequence[str],
    batch_size: int = 32,
    partitions: int | None = None,
) -> DataFrame:
    """Rows (*keys, result, error, started, finished): one per input, in batches.

    ``load_fn`` runs once per worker process and its failure fails the job.
    ``infer_fn(model, batch)`` gets a pandas frame of up to ``batch_size``
    items, across clips, and returns one output per item in order. When it
    raises or returns another number of outputs, every item of that batch
    becomes an error row. Nothing is shuffled unless ``partitions`` is given,
    which spreads light items (ids, paths, short text) by their keys so that
    few input splits do not mean few model workers; never do that with pixels.
    """
    if isinstance(result_type, str):
        result_type = T.DataType.fromDDL(result_type)
    fields = [items.schema[k] for k in keys]
    schema = T.StructType(
        [
            *fields,
            T.StructField("result", result_type, True),
            T.StructField("error", T.StringType(), True),
            T.StructField("started", T.TimestampType(), True),
            T.StructField("finished", T.TimestampType(), True),
        ]
    )

    names, call = list(keys), uuid.uuid4().hex

    def run(arrow_batches):
        model = _worker_model(call, load_fn)
        done: list[tuple] = []
        rows = 0
        for part in _rebatched(arrow_batches, batch_size):
            n, error, begin = len(part), None, _now_us()
            try:
                outputs = list(infer_fn(model, part))
                if len(outputs) != n:
                    raise ValueError(f"{len(outputs)} outputs for {n} items")
            except Exception as failure:
                outputs, error = [None] * n, f"{type(failure).__name__}: {failure}"
            keys_of = [part[name].to_numpy() for name in names]
            done.append((keys_of, outputs, error, begin, _now_us()))
            rows += n
            if rows >= _OUTPUT_ROWS:
                yield _output(names, done)
                done, rows = [], 0
        if done:
            yield _output(names, done)

    if partitions is not None:
        items = items.repartition(partitions, *names)
    return items.mapInPandas(run, schema)


def scored_rows(scored: DataFrame) -> DataFrame:
    """Successful items with their result's fields as columns."""
    kept = scored.where(F.col("error").isNull())
    others = [c for c in scored.columns if c not in ("result", "error", "started", "finished")]
    if isinstance(scored.schema["result"].dataType, T.StructType):
        return kept.select(*others, "result.*")
    return kept.select(*others, "result")


def error_rows(scored: DataFrame) -> DataFrame:
    """Failed items; they are absent from results, so a resumed run retries them."""
    return scored.where(F.col("error").isNotNull()).drop("result")


def run_log(scored: DataFrame, metric: str, key: str = "clip_id") -> DataFrame:
    """One log row per clip: first start, last finish and an error if any item failed."""
    return scored.groupBy(F.col(key).alias("video_id")).agg(
        F.lit(metric).alias("metric"),
        F.min("started").alias("started"),
        F.max("finished").alias("finished"),
        F.min("error").alias("error"),
    )


def fan_out(rows: DataFrame, choices: DataFrame) -> DataFrame:
    """Every row with every row of a small fixed table.

    The table becomes a literal array that each row unfolds, so this is a
    narrow step without a join. More than a thousand choices are refused.
    """
    options = [
        F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in choices.schema])
        for row in few_rows(choices)
    ]
    return rows.select("*", F.inline(F.array(*options)))


def prompt_fanout(frames: DataFrame, prompts: DataFrame) -> DataFrame:
    """Every frame with every prompt."""
    return fan_out(frames, prompts)


def question_fanout(clips: DataFrame, questions: DataFrame) -> DataFrame:
    """Every clip with every question; decode clips before this step, not after."""
    return fan_out(clips, questions)
