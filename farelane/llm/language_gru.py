"""Language identification: a bidirectional gated recurrent network over bytes.

Texts are cut into windows of WINDOW bytes.  In each window one network reads
forwards and one backwards; at every byte both states give a label
distribution, and the document's probabilities are the mean over all its
bytes.  The network is trained here in numpy by backpropagation through time,
on a bounded sample: SAMPLE_ROWS documents of each language at most, those
with the smallest hash of their id, and of each the windows that random
numbers pick.  Prediction reads every byte of every text.

State updates, for byte x and state h (column = window):
    z, r = gate(E_zr[x] + U_zr h),  c = squash(E_c[x] + r * (U_c h)),
    h' = h + z * (c - h)
with squash(v) = v / (1 + |v|) and gate(v) = (1 + squash(v)) / 2, which cost a
third of tanh and the logistic function here and separate as well.

Defined results: NULL text or text without letters is ``und`` with score 1;
without training rows every other text is ``und`` with score 0.  Rows with
NULL language teach nothing.  One result row per input row, repeated rows too;
an empty table gives none.  Columns other than the id and the text are ignored
in prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

UNDETERMINED = "und"
WINDOW, HIDDEN = 96, 8
SAMPLE_ROWS, SAMPLE_CHARS = 1500, 2000
STEPS, BATCH, RATE = 250, 128, 0.02
#: Windows that are read side by side.
SIDE_BY_SIDE = 4096


def _squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


@dataclass
class Network:
    """Per direction: byte table (3H x 256) and recurrence (3H x H); the
    output layer (C x 2H) and bias; the labels' names."""

    langs: list[str]
    tables: list[np.ndarray]
    loops: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [*self.tables, *self.loops, self.out, self.bias]


def network(langs: list[str], seed: int = 11) -> Network:
    rng = np.random.default_rng(seed)
    f = np.float32
    return Network(langs, [rng.normal(0, 0.3, (3 * HIDDEN, 256)).astype(f) for _ in range(2)],
                   [rng.normal(0, 0.3, (3 * HIDDEN, HIDDEN)).astype(f) for _ in range(2)],
                   rng.normal(0, 0.3, (len(langs), 2 * HIDDEN)).astype(f), np.zeros((len(langs), 1), f))


def _read(table: np.ndarray, loop: np.ndarray, steps: np.ndarray, keep: bool):
    """States (T x H x B) of one direction over ``steps`` (T x B bytes), and
    what backpropagation needs."""
    t, b = steps.shape
    states = np.zeros((t + 1, HIDDEN, b), np.float32)
    kept = []
    for i in range(t):
        h = states[i]
        e = np.take(table, steps[i], axis=1)
        u = loop @ h
        zr = 0.5 * _squash(e[:2 * HIDDEN] + u[:2 * HIDDEN]) + 0.5
        z, r = zr[:HIDDEN], zr[HIDDEN:]
        c = _squash(e[2 * HIDDEN:] + r * u[2 * HIDDEN:])
        states[i + 1] = h + z * (c - h)
        if keep:
            kept.append((zr, c, u[2 * HIDDEN:]))
    return states, kept


def _probabilities(net: Network, fwd: np.ndarray, bwd: np.ndarray) -> np.ndarray:
    """T x C x B label distributions of every position."""
    p = net.out[:, :HIDDEN] @ fwd + net.out[:, HIDDEN:] @ bwd
    p += net.bias
    p -= p.max(axis=1, keepdims=True)
    np.exp(p, out=p)
    p /= p.sum(axis=1, keepdims=True)
    return p


def _states(table: np.ndarray, loop: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """States behind each step, as ``_read``, with buffers used again."""
    t, b = steps.shape
    states = np.empty((t, HIDDEN, b), np.float32)
    e, u, d, h = *(np.empty((3 * HIDDEN, b), np.float32) for _ in range(3)), np.zeros((HIDDEN, b), np.float32)
    zr, z, r, c = e[:2 * HIDDEN], e[:HIDDEN], e[HIDDEN:2 * HIDDEN], e[2 * HIDDEN:]
    for i in range(t):
        np.take(table, steps[i], axis=1, out=e, mode="clip")
        np.matmul(loop, h, out=u)
        zr += u[:2 * HIDDEN]
        np.abs(zr, out=d[:2 * HIDDEN])
        d[:2 * HIDDEN] += 1
        zr /= d[:2 * HIDDEN]
        zr += 1
        zr *= 0.5
        np.multiply(r, u[2 * HIDDEN:], out=r)
        c += r
        np.abs(c, out=d[2 * HIDDEN:])
        d[2 * HIDDEN:] += 1
        c /= d[2 * HIDDEN:]
        c -= h
        c *= z
        h = np.add(h, c, out=states[i])
    return states


def positions(net: Network, windows: np.ndarray) -> np.ndarray:
    """Label distributions (T x C x B) for windows (T x B bytes)."""
    return _probabilities(net, _states(net.tables[0], net.loops[0], windows),
                          _states(net.tables[1], net.loops[1], windows[::-1])[::-1])


def _back(loop: np.ndarray, steps: np.ndarray, states: np.ndarray, kept: list, dh_out: np.ndarray):
    """Gradients of a direction's table and recurrence; ``dh_out``: the loss
    gradient at each step's state."""
    t, b = steps.shape
    g_table, g_loop = np.zeros((3 * HIDDEN, 256), np.float32), np.zeros_like(loop)
    dh = np.zeros((HIDDEN, b), np.float32)
    for i in range(t - 1, -1, -1):
        zr, c, uc = kept[i]
        h, z, r = states[i], zr[:HIDDEN], zr[HIDDEN:]
        dh = dh + dh_out[i]
        # squash' = (1 - |squash|)^2; a gate's squash is 2 * gate - 1
        da_c = dh * z * (1 - np.abs(c)) ** 2
        da_z = dh * (c - h) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
        da_r = da_c * uc * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
        da = np.concatenate([da_z, da_r, da_c])
        du = np.concatenate([da_z, da_r, da_c * r])
        g_loop += du @ h.T
        onehot = np.zeros((b, 256), np.float32)
        onehot[np.arange(b), steps[i]] = 1
        g_table += da @ onehot
        dh = dh * (1 - z) + loop.T @ du
    return g_table, g_loop


def gradients(net: Network, windows: np.ndarray, labels: np.ndarray):
    """Loss (mean cross entropy over positions) and its gradients, in the
    order of ``Network.parameters``."""
    t, b = windows.shape
    fs, fk = _read(net.tables[0], net.loops[0], windows, True)
    bs, bk = _read(net.tables[1], net.loops[1], windows[::-1], True)
    fwd, bwd = fs[1:], bs[1:][::-1]
    p = _probabilities(net, fwd, bwd)
    at = np.arange(b)
    loss = -np.log(np.maximum(p[:, labels, at], 1e-12)).mean()
    d = p
    d[:, labels, at] -= 1
    d /= t * b
    both = np.concatenate([fwd, bwd], axis=1)
    g_out = (d @ both.transpose(0, 2, 1)).sum(axis=0)
    g_bias = d.sum(axis=(0, 2))[:, None]
    d_both = net.out.T @ d
    gt0, gl0 = _back(net.loops[0], windows, fs, fk, d_both[:, :HIDDEN])
    gt1, gl1 = _back(net.loops[1], windows[::-1], bs, bk, d_both[::-1, HIDDEN:])
    return float(loss), [gt0, gt1, gl0, gl1, g_out, g_bias]


def train(texts: list[bytes], langs: list[str], seed: int = 11) -> Network:
    """Adam over random windows; classes are drawn equally often."""
    names = sorted(set(langs))
    net = network(names, seed)
    if len(names) < 2:
        return net
    rng = np.random.default_rng(seed)
    pools = [[t for t, l in zip(texts, langs) if l == name and t] for name in names]
    params = net.parameters()
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        y = rng.integers(0, len(names), BATCH)
        x = np.full((WINDOW, BATCH), 32, np.uint8)
        for j, c in enumerate(y):
            t = pools[c][rng.integers(len(pools[c]))]
            lo = rng.integers(0, max(1, len(t) - WINDOW + 1))
            part = np.frombuffer(t[lo:lo + WINDOW], np.uint8)
            x[:len(part), j] = part
        _, grads = gradients(net, x, y)
        scale = min(1.0, 1.0 / (np.sqrt(sum(float((g * g).sum()) for g in grads)) + 1e-12))
        rate = RATE * (1 - 0.9 * step / STEPS)
        for p, g, m, v in zip(params, grads, first, second):
            g = g * scale
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_rows: int = SAMPLE_ROWS) -> Network:
    """Learn from ``docs``: a sample of bounded size, spread over languages.

    Languages come from the data; SAMPLE_ROWS rows of each at most reach the
    driver, cut to SAMPLE_CHARS characters from a place that hashing picks."""
    rows = docs.where(F.col(lang_col).isNotNull() & (F.length(F.trim(F.col(text_col))) > 0)).select(
        F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col)).alias("h"), F.col(id_col).alias("key"))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    # a hash threshold keeps about twice the sample; the exact cut is made on what is left
    low = F.lit(False)
    for lang, n in counts.items():
        limit = int(-(1 << 63) + min(1.0, 2.0 * sample_rows / n) * ((1 << 64) - 1))
        low = low | ((F.col("lang") == lang) & (F.col("h") <= F.lit(min(limit, (1 << 63) - 1))))
    start = F.pmod(F.xxhash64(F.col(id_col), F.lit(1)), F.greatest(F.length(F.col(text_col)) - SAMPLE_CHARS, F.lit(0)) + 1).cast("int")
    picked = (docs.where(F.length(F.trim(F.col(text_col))) > 0).select(
        F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col)).alias("h"),
        F.substring(F.col(text_col), start + 1, F.lit(SAMPLE_CHARS)).alias("text")).where(low))
    got = picked.toPandas().sort_values(["h", "lang", "text"]).groupby("lang").head(sample_rows)
    return train([t.encode() for t in got["text"]], got["lang"].tolist())


def _windows(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (T x W), the document of each and its number of real bytes."""
    owner, real, parts = [], [], []
    for i, raw in enumerate(raws):
        n = -(-len(raw) // WINDOW)
        parts.append(raw + b" " * (n * WINDOW - len(raw)))
        owner += [i] * n
        real += [WINDOW] * (n - 1) + [len(raw) - (n - 1) * WINDOW] if n else []
    x = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, WINDOW)
    return x, np.array(owner, np.int64), np.array(real, np.int64)


def pooled(net: Network, raws: list[bytes]) -> np.ndarray:
    """Mean label distribution (C x documents) over all bytes of each text."""
    x, owner, real = _windows(raws)
    total = np.zeros((len(net.langs), len(raws)))
    for lo in range(0, len(x), SIDE_BY_SIDE):
        w = np.ascontiguousarray(x[lo:lo + SIDE_BY_SIDE].T)
        p = positions(net, w)
        short = np.flatnonzero(real[lo:lo + SIDE_BY_SIDE] < WINDOW)
        for j in short:
            p[real[lo + j]:, :, j] = 0
        sums = p.sum(axis=0, dtype=np.float64)
        for c in range(len(net.langs)):
            total[c] += np.bincount(owner[lo:lo + SIDE_BY_SIDE], sums[c], len(raws))
    return total / np.maximum(1, np.array([len(r) for r in raws]))


def predict(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, lang_pred, score`` for every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            letters = [any(map(str.isalpha, t)) for t in texts]
            if len(net.langs) > 1:
                p = pooled(net, [t.encode() if ok else b"" for t, ok in zip(texts, letters)])
                best, top = p.argmax(axis=0), p.max(axis=0)
            else:
                best, top = np.zeros(len(texts), int), np.full(len(texts), float(len(net.langs)))
            names = [(net.langs[b] if net.langs else UNDETERMINED) if ok else UNDETERMINED for b, ok in zip(best, letters)]
            score = np.where(letters, np.clip(top, 0, 1), 1.0)
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                                             names=[id_col, "lang_pred", "score"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")
