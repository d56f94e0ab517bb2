"""NumPy kernels for a ReLU MLP, run inside Spark tasks on Arrow batches.

Parameters are a list of ``(W, b)`` with ``W`` of shape ``(out, in)``.
Hidden layers use ReLU; the last layer gives logits.  Loss is softmax
cross-entropy averaged over the batch; gradients are the closed-form
back-propagation of that mean; the optimizer is Adam.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np

Params = list  # list[tuple[np.ndarray, np.ndarray]]

ADAM_BETA1 = 0.9
ADAM_BETA2 = 0.999
ADAM_EPS = 1e-8


def layer_bound(layer: int, n_layers: int, fan_in: int, fan_out: int) -> float:
    """Uniform init bound: Kaiming (ReLU gain) for hidden layers, Xavier for
    the output layer."""
    if layer < n_layers - 1:
        return math.sqrt(6.0 / fan_in)
    return math.sqrt(6.0 / (fan_in + fan_out))


def md5_uniform(text: str) -> float:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 4294967296.0


def init_params(layers: Sequence[int], seed: object) -> Params:
    """``w[l][i][j] = bound_l * (2 u - 1)`` with ``u = md5("seed:l:i:j")``,
    zero biases (F1).  Same numbers as ``model.init_params_df`` on Spark."""
    out = []
    n = len(layers) - 1
    for lay in range(n):
        fi, fo = layers[lay], layers[lay + 1]
        bound = layer_bound(lay, n, fi, fo)
        # first 4 digest bytes, big-endian == first 8 hex digits
        md5 = hashlib.md5
        raw = b"".join(md5(f"{seed}:{lay}:{i}:{j}".encode()).digest()[:4]
                       for i in range(fo) for j in range(fi))
        u = np.frombuffer(raw, dtype=">u4").astype(np.float64) / 4294967296.0
        w = (bound * (2.0 * u - 1.0)).reshape(fo, fi)
        out.append((w, np.zeros(fo)))
    return out


def forward(params: Params, x: np.ndarray, keep: bool = False):
    """Logits for rows of ``x``; with ``keep`` also every layer's output."""
    acts = [x]
    h = x
    for k, (w, b) in enumerate(params):
        z = h @ w.T + b
        h = np.maximum(z, 0.0) if k < len(params) - 1 else z
        acts.append(h)
    return (h, acts) if keep else h


def row_losses(logits: np.ndarray, y: np.ndarray) -> np.ndarray:
    m = logits.max(axis=1, keepdims=True)
    lse = np.log(np.exp(logits - m).sum(axis=1)) + m[:, 0]
    return lse - logits[np.arange(len(y)), y]


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def loss_grad_sums(params: Params, x: np.ndarray, y: np.ndarray):
    """Sum over rows of the loss and of its gradient (divide by the row count
    for the mean).  Sums let partitions be combined exactly."""
    logits, acts = forward(params, x, keep=True)
    loss_sum = float(row_losses(logits, y).sum())
    delta = softmax(logits)
    delta[np.arange(len(y)), y] -= 1.0
    grads = [None] * len(params)
    for k in range(len(params) - 1, -1, -1):
        w, _ = params[k]
        grads[k] = (delta.T @ acts[k], delta.sum(axis=0))
        if k:
            delta = (delta @ w) * (acts[k] > 0)
    return loss_sum, grads


def zeros_like(params: Params) -> Params:
    return [(np.zeros_like(w), np.zeros_like(b)) for w, b in params]


def adam_update(params: Params, grads: Params, m: Params, v: Params, step: int, lr: float):
    """One Adam step (step is 1-based after the increment); returns new
    (params, m, v)."""
    bc1 = 1.0 - ADAM_BETA1 ** step
    bc2 = 1.0 - ADAM_BETA2 ** step
    new_p, new_m, new_v = [], [], []
    for (w, b), (gw, gb), (mw, mb), (vw, vb) in zip(params, grads, m, v):
        pair_p, pair_m, pair_v = [], [], []
        for p, g, mm, vv in ((w, gw, mw, vw), (b, gb, mb, vb)):
            mm = ADAM_BETA1 * mm + (1.0 - ADAM_BETA1) * g
            vv = ADAM_BETA2 * vv + (1.0 - ADAM_BETA2) * g * g
            denom = np.sqrt(vv) / math.sqrt(bc2) + ADAM_EPS
            p = p - (lr / bc1) * mm / denom
            pair_p.append(p), pair_m.append(mm), pair_v.append(vv)
        new_p.append(tuple(pair_p)), new_m.append(tuple(pair_m)), new_v.append(tuple(pair_v))
    return new_p, new_m, new_v


# ---------------------------------------------------------------- flat layout

def flatten(params: Params) -> np.ndarray:
    return np.concatenate([np.concatenate([w.ravel(), b]) for w, b in params])


def unflatten(vec: np.ndarray, layers: Sequence[int]) -> Params:
    out, o = [], 0
    for fi, fo in zip(layers[:-1], layers[1:]):
        w = vec[o:o + fi * fo].reshape(fo, fi)
        o += fi * fo
        b = vec[o:o + fo]
        o += fo
        out.append((w.copy(), b.copy()))
    return out


def n_params(layers: Sequence[int]) -> int:
    return sum(fi * fo + fo for fi, fo in zip(layers[:-1], layers[1:]))


def param_index(layers: Sequence[int]):
    """(layer, i, j) of each flat position; bias entries have j = -1."""
    lay, ii, jj = [], [], []
    for k, (fi, fo) in enumerate(zip(layers[:-1], layers[1:])):
        i, j = np.divmod(np.arange(fi * fo), fi)
        lay += [np.full(fi * fo, k), np.full(fo, k)]
        ii += [i, np.arange(fo)]
        jj += [j, np.full(fo, -1)]
    return np.concatenate(lay), np.concatenate(ii), np.concatenate(jj)


def sgd_epoch(params: Params, m: Params, v: Params, step: int, x: np.ndarray,
              y: np.ndarray, batch_size: int, lr: float, drop_last: bool = False):
    """Plain one-process mini-batch Adam over rows in the given order (the
    W=1 reference behaviour); returns params, m, v, step, loss sum, steps."""
    n = len(y)
    stop = (n // batch_size) * batch_size if drop_last else n
    loss_total, steps = 0.0, 0
    for s in range(0, stop, batch_size):
        xb, yb = x[s:s + batch_size], y[s:s + batch_size]
        if len(yb) == 0:
            break
        ls, g = loss_grad_sums(params, xb, yb)
        g = [(gw / len(yb), gb / len(yb)) for gw, gb in g]
        step += 1
        params, m, v = adam_update(params, g, m, v, step, lr)
        loss_total += ls / len(yb)
        steps += 1
    return params, m, v, step, loss_total, steps


def flat_positions(layers: Sequence[int], lay: np.ndarray, i: np.ndarray,
                   j: np.ndarray) -> np.ndarray:
    """Flat index of (layer, i, j) entries (bias: j = -1); -1 where out of
    range (a misshapen entry)."""
    lay, i, j = (np.asarray(a, dtype=np.int64) for a in (lay, i, j))
    fi = np.array(layers[:-1], dtype=np.int64)
    fo = np.array(layers[1:], dtype=np.int64)
    start = np.concatenate([[0], np.cumsum(fi * fo + fo)])[:-1]
    ok = (lay >= 0) & (lay < len(fi))
    L = np.where(ok, lay, 0)
    ok &= (i >= 0) & (i < fo[L]) & (j >= -1) & (j < fi[L])
    pos = np.where(j >= 0, start[L] + i * fi[L] + j, start[L] + fi[L] * fo[L] + i)
    return np.where(ok, pos, -1)
