"""Array-valued expressions for features, logits and losses.

All of these are Catalyst higher-order functions, so they stay in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def assemble(cols: Sequence[str], dtype: str = "double") -> Column:
    """Dense feature vector from scalar columns."""
    return F.array(*[F.col(c).cast(dtype) for c in cols])


def argmax(arr: Column) -> Column:
    """0-based index of the largest element, first one on ties."""
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def relu(arr: Column) -> Column:
    """Element-wise max(v, 0)."""
    return F.transform(arr, lambda v: F.greatest(v, F.lit(0.0)))


def one_hot(label: Column, levels: Sequence) -> Column:
    """Full-width 0/1 vector; a value outside ``levels`` gives all zeros."""
    lv = F.array(*[F.lit(v) for v in levels])
    return F.transform(lv, lambda v: F.when(v == label, F.lit(1.0)).otherwise(F.lit(0.0)))


def dense_layer(x: Column, weights: Sequence[Sequence[float]],
                bias: Sequence[float]) -> Column:
    """Affine map ``W x + b`` as an expression (F2), with ``weights[j][i]`` the
    weight from input i to output j.  For small layers only: the matrix is
    inlined into the plan.  Large models are scored with ``score``."""
    outs = []
    for row, b in zip(weights, bias):
        wr = F.array(*[F.lit(float(w)) for w in row])
        outs.append(F.aggregate(F.zip_with(x, wr, lambda a, w: a * w),
                                F.lit(float(b)), lambda acc, v: acc + v))
    return F.array(*outs)


def cross_entropy(logits: Column, label: Column) -> Column:
    """Softmax cross-entropy of one row against a class index (F5):
    ``log(sum(exp(z - m))) + m - z[label]`` with ``m = max(z)``."""
    m = F.array_max(logits)
    lse = F.log(F.aggregate(logits, F.lit(0.0), lambda acc, z: acc + F.exp(z - m))) + m
    return lse - F.element_at(logits, label.cast("int") + 1)
