"""Schemas of the engine's tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BinaryType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


CLIPS = _table(video_id=_S, path=_S, length=_L, modified=T.TimestampType())
CATALOG = _table(ord=_L, yt_clip_title=_S, yt_clip_link=_S)
SCENES = _table(video_id=_S, title=_S, clean_title=_S, scene=_S, path=_S)
VIDEO_META = _table(clip_id=_S, fps=_D, total_frames=_I, width=_I, height=_I)
FRAMES = _table(
    clip_id=_S, frame_no=_I, ts_s=_D, is_key=T.BooleanType(), height=_I, width=_I,
    channels=_S, pixels=_B,
)
GRAY_FRAMES = _table(clip_id=_S, sample_no=_L, height=_I, width=_I, gray=_B)
FLOWS = _table(
    clip_id=_S, pair_no=_L, height=_I, width=_I,
    u=T.ArrayType(T.FloatType()), v=T.ArrayType(T.FloatType()),
)
TRACKS = _table(
    clip_id=_S, pair_no=_L, point_id=_I, x0=_D, y0=_D, x1=_D, y1=_D, status=_I
)
FRAME_SCORES = _table(clip_id=_S, sample_no=_L, score=_D)
FRAME_EMBEDDINGS = _table(clip_id=_S, sample_no=_L, embedding=T.ArrayType(T.FloatType()))
FRAME_LOGITS = _table(clip_id=_S, sample_no=_L, logits=T.ArrayType(_D))
FRAME_LABELS = _table(clip_id=_S, sample_no=_L, file=_S, label=_S)
DETECTIONS = _table(clip_id=_S, frame_no=_I, x1=_D, y1=_D, x2=_D, y2=_D, label=_S, conf=_D)
PROMPT_ANSWERS = _table(clip_id=_S, frame_no=_I, p_idx=_I, answer=T.MapType(_S, _S))
QUESTION_TABLE = _table(q_idx=_I, question=_S, weight=_D)
ANSWERS = _table(clip_id=_S, q_idx=_I, answer=_S)
RUN_LOG = _table(
    metric=_S, video_id=_S, seq=_L, started=T.TimestampType(), finished=T.TimestampType(), error=_S
)
