"""Vector arithmetic for model heads.

Small vectors (logits) stay in SQL expressions. Embedding-sized ones go
through one Arrow batch and a numpy matrix product: array lambdas are
interpreted element by element, which is slower from a few dozen elements on.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmeter.fixed_values import CHANNEL_DEVIATIONS, CHANNEL_MEANS
from reelmeter.functions.arithmetic import evaluated_once


def fold_affine(layers: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, float]:
    """One weight vector and bias for a stack of linear layers without activations.

    Each layer is ``(weights[out, in], bias[out])``; the last one has one output.
    """
    weights, bias = layers[0]
    weights, bias = np.asarray(weights, "float64"), np.asarray(bias, "float64")
    for w, b in layers[1:]:
        w = np.asarray(w, "float64")
        weights, bias = w @ weights, w @ bias + np.asarray(b, "float64")
    return weights.reshape(-1), float(bias.reshape(-1)[0])


def aesthetic_head(embedding: Column, weights: Sequence[float], bias: float) -> Column:
    """Affine score of the embedding scaled to unit length."""
    w = np.asarray(weights, "float64")

    @F.pandas_udf(T.DoubleType())
    def score(batch: pd.Series) -> pd.Series:
        if batch.empty:
            return pd.Series([], dtype="float64")
        vectors = np.stack(batch.to_numpy()).astype("float64")
        norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        with np.errstate(divide="ignore", invalid="ignore"):
            return pd.Series(vectors @ w / norms + bias)

    return evaluated_once(score)(embedding)


def watermark_head(
    features: Column,
    layers: Sequence[tuple[np.ndarray, np.ndarray]],
    batch_size: int = 1024,
) -> Column:
    """First softmax share of a perceptron with ReLU between its layers."""
    stack = [(np.asarray(w, "float64"), np.asarray(b, "float64")) for w, b in layers]

    def load():
        def predict(inputs: np.ndarray) -> np.ndarray:
            x = inputs.astype("float64")
            for i, (w, b) in enumerate(stack):
                x = x @ w.T + b
                if i < len(stack) - 1:
                    x = np.maximum(x, 0.0)
            e = np.exp(x - x.max(axis=1, keepdims=True))
            return e[:, 0] / e.sum(axis=1)

        return predict

    run = predict_batch_udf(
        load,
        return_type=T.DoubleType(),
        batch_size=batch_size,
        input_tensor_shapes=[[stack[0][0].shape[1]]],
    )
    return evaluated_once(run)(features)


def argmax_label(logits: Column, labels: Sequence[str]) -> Column:
    """Label of the largest logit; the first one on ties."""
    names = F.array(*[F.lit(name) for name in labels])
    return F.get(names, (F.array_position(logits, F.array_max(logits)) - 1).cast("int"))


def image_normalise(
    pixels: Column, means: Sequence[float] = CHANNEL_MEANS, deviations: Sequence[float] = CHANNEL_DEVIATIONS
) -> Column:
    """Interleaved 8-bit RGB bytes to ``(x / 255 - mean) / deviation``, channel by channel.

    Resizing to the model's input size belongs to the decoder plug-in.
    """
    m, d = np.asarray(means, "float64"), np.asarray(deviations, "float64")

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def scale(batch: pd.Series) -> pd.Series:
        def one(cell) -> np.ndarray:
            rgb = as_bytes(cell).reshape(-1, len(m)) / 255.0
            return ((rgb - m) / d).astype("float32").reshape(-1)

        return batch.map(one)

    return evaluated_once(scale)(pixels)


def as_bytes(cell) -> np.ndarray:
    """A pixel cell (binary or array of ints) as a flat uint8 array."""
    if isinstance(cell, (bytes, bytearray, memoryview)):
        return np.frombuffer(cell, dtype=np.uint8)
    return np.asarray(cell).astype(np.uint8)
