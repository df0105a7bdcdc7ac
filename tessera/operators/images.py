"""Image and network-layer operators over row-major ``array<float>`` pixels.

Every operator here is a per-row array expression (``transform`` /
``aggregate`` / ``zip_with``) with the layer weights folded in as literals:
no shuffle, no Python in the task, any number of rows.  For networks too
large for literal weights, :func:`dense_forward_pandas` runs the same forward
pass with NumPy inside ``mapInPandas`` on Arrow batches, weights broadcast once.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import BATCHNORM_EPS, arr_sum, softmax

ACTIVATIONS = ("linear", "relu", "sigmoid", "tanh", "softmax")


def _lits(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def normalize(px: Column, scale: float = 255.0) -> Column:
    """Pixel scaling ``x / 255`` (as double)."""
    return F.transform(px, lambda v: v.cast("double") / F.lit(scale))


def reshape(px: Column, h: int, w: int) -> Column:
    """Row-major vector -> ``h`` rows of ``w`` values."""
    return F.transform(F.sequence(F.lit(0), F.lit(h - 1)), lambda r: F.slice(px, r * w + 1, w))


def flatten(nested: Column) -> Column:
    return F.flatten(nested)


def label_onehot(label: Column, k: int) -> Column:
    """``to_categorical``: a k-vector with 1 at the label."""
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                       lambda i: F.when(i == label, F.lit(1)).otherwise(F.lit(0)))


def activate(z: Column, activation: str) -> Column:
    if activation == "linear":
        return z
    if activation == "relu":
        return F.transform(z, lambda v: F.greatest(v, F.lit(0.0)))
    if activation == "sigmoid":
        return F.transform(z, lambda v: F.lit(1.0) / (F.lit(1.0) + F.exp(-v)))
    if activation == "tanh":
        return F.transform(z, lambda v: F.tanh(v))
    if activation == "softmax":
        return softmax(z)
    raise ValueError(activation)


def dense(x: Column, weights: Sequence[Sequence[float]], bias: Sequence[float],
          activation: str = "linear") -> Column:
    """One dense layer: ``act(W x + b)``; ``weights[j]`` holds output j's
    input weights."""
    xd = F.transform(x, lambda v: v.cast("double"))
    outs = []
    for wj, bj in zip(weights, bias):
        dot = F.aggregate(F.zip_with(xd, _lits(wj), lambda a, b: a * b), F.lit(0.0),
                          lambda acc, v: acc + v)
        outs.append(F.lit(float(bj)) + dot)
    return activate(F.array(*outs), activation)


def batchnorm(x: Column, mean: Sequence[float], var: Sequence[float], gamma: Sequence[float],
              beta: Sequence[float], eps: float = BATCHNORM_EPS) -> Column:
    """Inference-time batch normalisation per position:
    ``(x - mean) / sqrt(var + eps) * gamma + beta``."""
    m, v_, g, b = _lits(mean), _lits(var), _lits(gamma), _lits(beta)
    return F.transform(x, lambda val, i: (val.cast("double") - F.element_at(m, i + 1))
                       / F.sqrt(F.element_at(v_, i + 1) + F.lit(eps))
                       * F.element_at(g, i + 1) + F.element_at(b, i + 1))


def _pixel(px: Column, h: int, w: int, r: Column, c: Column) -> Column:
    """px[r, c] with zero padding outside the image."""
    inside = (r >= 0) & (r < h) & (c >= 0) & (c < w)
    return F.when(inside, F.element_at(px, r * w + c + 1).cast("double")).otherwise(F.lit(0.0))


UNROLL_LIMIT = 256  # multiply-adds per row up to which conv2d is unrolled (codegen size)


def conv2d(px: Column, h: int, w: int, kernels: Sequence[Sequence[Sequence[float]]],
           bias: Sequence[float], padding: str = "same") -> Column:
    """2-D cross-correlation (see :func:`conv2d_lambda`).  Small shapes are
    unrolled into static ``element_at`` terms with literal weights (padding
    resolved at plan time; fully code-generated); larger ones use the
    higher-order-function form."""
    k = len(kernels[0])
    nf = len(kernels)
    if nf * h * w * k * k > UNROLL_LIMIT:
        return conv2d_lambda(px, h, w, kernels, bias, padding)
    if padding == "same":
        pad, ho, wo = (k - 1) // 2, h, w
    elif padding == "valid":
        pad, ho, wo = 0, h - k + 1, w - k + 1
    else:
        raise ValueError(padding)
    cells = []
    for f in range(nf):
        for r in range(ho):
            for cc in range(wo):
                acc = F.lit(float(bias[f]))
                for dy in range(k):
                    for dx in range(k):
                        i, j = r + dy - pad, cc + dx - pad
                        if 0 <= i < h and 0 <= j < w:
                            acc = acc + F.lit(float(kernels[f][dy][dx])) * \
                                F.element_at(px, i * w + j + 1).cast("double")
                cells.append(acc)
    return F.array(*cells)


def conv2d_lambda(px: Column, h: int, w: int, kernels: Sequence[Sequence[Sequence[float]]],
                  bias: Sequence[float], padding: str = "same") -> Column:
    """2-D cross-correlation of a one-channel image with ``len(kernels)``
    k x k filters, stride 1.  Output: filter-major ``(f, r, c)`` row-major
    vector.  "same" pads (k-1) div 2 on top/left (rest bottom/right), "valid"
    does not pad."""
    k = len(kernels[0])
    if padding == "same":
        pad, ho, wo = (k - 1) // 2, h, w
    elif padding == "valid":
        pad, ho, wo = 0, h - k + 1, w - k + 1
    else:
        raise ValueError(padding)
    nf = len(kernels)
    flat_w = _lits([kernels[f][dy][dx] for f in range(nf) for dy in range(k) for dx in range(k)])
    b = _lits(bias)

    def cell(o):
        f = F.floor(o / (ho * wo)).cast("int")
        rem = o - f * (ho * wo)
        r = F.floor(rem / wo).cast("int")
        cc = rem - r * wo
        acc = F.element_at(b, f + 1)
        for dy in range(k):
            for dx in range(k):
                wgt = F.element_at(flat_w, f * (k * k) + (dy * k + dx) + 1)
                acc = acc + wgt * _pixel(px, h, w, r + (dy - pad), cc + (dx - pad))
        return acc

    return F.transform(F.sequence(F.lit(0), F.lit(nf * ho * wo - 1)), cell)


def pool2d(px: Column, h: int, w: int, kind: str = "avg", size: int = 2) -> Column:
    """size x size pooling, stride = size; an odd last row/column is dropped."""
    ho, wo = h // size, w // size

    def cell(o):
        r = F.floor(o / wo).cast("int")
        cc = o - r * wo
        vals = [F.element_at(px, (r * size + dy) * w + (cc * size + dx) + 1).cast("double")
                for dy in range(size) for dx in range(size)]
        if kind == "max":
            return F.greatest(*vals)
        tot = vals[0]
        for v in vals[1:]:
            tot = tot + v
        return tot / F.lit(float(size * size))

    return F.transform(F.sequence(F.lit(0), F.lit(ho * wo - 1)), cell)


def global_avg_pool(px: Column) -> Column:
    """One value per channel (one channel here): the mean of the map."""
    return arr_sum(F.transform(px, lambda v: v.cast("double"))) / F.size(px)


def residual_add(x: Column, shortcut: Column) -> Column:
    """``relu(x + shortcut)`` element-wise."""
    return F.zip_with(x, shortcut, lambda a, b: F.greatest(a.cast("double") + b.cast("double"),
                                                          F.lit(0.0)))


# ---- NumPy fast path ----------------------------------------------------------

class _Local:
    """Stand-in for a broadcast when there is no SparkContext (the value then
    travels inside the task closure; fine for weights of this size)."""

    def __init__(self, value):
        self.value = value


def _share(spark, value):
    try:
        return spark.sparkContext.broadcast(value)
    except Exception:  # noqa: BLE001
        return _Local(value)


def _np_act(z: np.ndarray, activation: str) -> np.ndarray:
    if activation == "relu":
        return np.maximum(z, 0.0)
    if activation == "sigmoid":
        return 1.0 / (1.0 + np.exp(-z))
    if activation == "tanh":
        return np.tanh(z)
    if activation == "softmax":
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)
    return z


def dense_forward_pandas(df: DataFrame, vec_col: str, layers: Sequence[tuple], keep: Sequence[str],
                         out: str = "out") -> DataFrame:
    """Forward pass of a stack of dense layers ``[(W (out x in), b, act), ...]``
    with NumPy per Arrow batch.  The weights are broadcast once and shared by
    every task; rows never leave their partition."""
    bc = _share(df.sparkSession, [(np.asarray(W, dtype=np.float64),
                                   np.asarray(b, dtype=np.float64), act) for W, b, act in layers])
    keep = list(keep)
    key_fields = [f for f in df.schema.fields if f.name in keep]
    from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

    schema = StructType(key_fields + [StructField(out, ArrayType(DoubleType()))])

    def run(batches):
        import pandas as pd

        net = bc.value
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = np.stack(pdf[vec_col].to_numpy()).astype(np.float64)
            for W, b, act in net:
                x = _np_act(x @ W.T + b, act)
            res = pd.DataFrame({k: pdf[k] for k in keep})
            res[out] = list(x)
            yield res

    cols = keep + ([vec_col] if vec_col not in keep else [])
    return df.select(*cols).mapInPandas(run, schema)


def conv2d_pandas(df: DataFrame, px_col: str, h: int, w: int,
                  kernels: Sequence[Sequence[Sequence[float]]], bias: Sequence[float],
                  padding: str = "same", keep: Sequence[str] = (), out: str = "out") -> DataFrame:
    """Same result as :func:`conv2d`, computed per Arrow batch with NumPy
    (sliding windows + einsum); kernels are broadcast once, rows stay in
    their partition.  Output vector is filter-major ``(f, r, c)``."""
    K = np.asarray(kernels, dtype=np.float64)
    bc = _share(df.sparkSession, (K, np.asarray(bias, dtype=np.float64)))
    keep = list(keep)
    from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

    schema = StructType([f for f in df.schema.fields if f.name in keep]
                        + [StructField(out, ArrayType(DoubleType()))])
    k = K.shape[1]
    pad = (k - 1) // 2 if padding == "same" else 0

    def run(batches):
        import pandas as pd
        from numpy.lib.stride_tricks import sliding_window_view

        kern, b = bc.value
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = np.stack(pdf[px_col].to_numpy()).astype(np.float64).reshape(-1, h, w)
            if padding == "same":
                x = np.pad(x, ((0, 0), (pad, k - 1 - pad), (pad, k - 1 - pad)))
            win = sliding_window_view(x, (k, k), axis=(1, 2))          # n, ho, wo, k, k
            y = np.einsum("nrcij,fij->nfrc", win, kern) + b[None, :, None, None]
            res = pd.DataFrame({c: pdf[c] for c in keep})
            res[out] = list(y.reshape(len(pdf), -1))
            yield res

    cols = keep + ([px_col] if px_col not in keep else [])
    return df.select(*cols).mapInPandas(run, schema)
