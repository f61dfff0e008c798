"""A bidirectional gated recurrent network over bytes, in numpy: forward, back-propagation, training.

Each direction keeps a state of ``size`` numbers per sequence. With byte ``b`` and state ``h``:

    z, r = gate(Wz[b] + h Uz), gate(Wr[b] + h Ur)     gate(x) = (1 + squash(x)) / 2
    n    = squash(Wn[b] + r * (h Un))
    h'   = n + z * (h - n)

``squash`` is the quotient x (27 + x^2) / (27 + 9 x^2) on [-3, 3], constant beyond: tanh to within 0.024,
with neither an exponential nor a jump in the slope. Every position is labelled by a softmax over the two
states that have read up to it, from the left and from the right.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

Params = dict[str, np.ndarray]


def _squash(x: np.ndarray, square: np.ndarray) -> np.ndarray:
    """In place; ``square`` is room for the squares."""
    np.clip(x, -3.0, 3.0, out=x)
    np.multiply(x, x, out=square)
    square += 27.0
    x *= square
    square *= 9.0
    square -= 216.0  # 9 (27 + x^2) - 216 = 27 + 9 x^2
    x /= square
    return x


def _slope(x: np.ndarray) -> np.ndarray:
    """Derivative of squash at ``x``, the value before squashing."""
    s = np.minimum(x * x, 9.0)
    return ((9.0 - s) / (3.0 * (3.0 + s))) ** 2


def initial(size: int, n_labels: int, rng: np.random.Generator) -> Params:
    def draw(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    params = {"bias": np.zeros(n_labels, np.float32)}
    for side in "fb":
        params[f"{side}_in_zr"] = draw(256, 2 * size, scale=0.3)
        params[f"{side}_in_n"] = draw(256, size, scale=0.6)
        params[f"{side}_zr"] = draw(size, 2 * size, scale=size ** -0.5)
        params[f"{side}_n"] = draw(size, size, scale=size ** -0.5)
        params[f"{side}_out"] = draw(size, n_labels, scale=size ** -0.5)
    return params


def segments(text_bytes: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut texts, laid end to end in ``text_bytes``, into rows of at most ``width`` bytes.

    Returns the rows padded with zeros, their lengths, and the number of the text of each row. Every byte
    is in exactly one row; texts without bytes have no row.
    """
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    counts = -(-lengths // width)
    owner = np.repeat(np.arange(len(lengths)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = starts[owner] + within * width
    size = np.minimum(width, lengths[owner] - within * width)
    places = first[:, None] + np.arange(width)
    inside = np.arange(width) < size[:, None]
    rows = np.zeros(places.shape, np.uint8)
    rows[inside] = text_bytes[places[inside]]
    return rows, size, owner


def _logits(params: Params, side: str, rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """What one direction says of every position, (labels, width, rows); only the current state is kept.

    From the right, a row that ends early keeps a zero state up to its last byte.
    """
    in_zr, in_n = params[f"{side}_in_zr"], params[f"{side}_in_n"]
    u_zr, u_n, out = params[f"{side}_zr"], params[f"{side}_n"], np.ascontiguousarray(params[f"{side}_out"].T)
    n_rows, width = rows.shape
    units = len(u_n)
    h = np.zeros((n_rows, units), np.float32)
    zr, zr_in = (np.empty((n_rows, 2 * units), np.float32) for _ in range(2))
    n, n_in = (np.empty((n_rows, units), np.float32) for _ in range(2))
    logits = np.empty((len(out), width, n_rows), np.float32)
    columns = np.ascontiguousarray(rows.T)
    short = np.flatnonzero(size < width)
    for t in range(width) if side == "f" else range(width - 1, -1, -1):
        in_zr.take(columns[t], axis=0, out=zr_in, mode="clip")
        in_n.take(columns[t], axis=0, out=n_in, mode="clip")
        np.matmul(h, u_zr, out=zr)
        zr += zr_in
        _squash(zr, zr_in)
        zr *= 0.5
        zr += 0.5
        np.matmul(h, u_n, out=n)
        n *= zr[:, units:]
        n += n_in
        _squash(n, n_in)
        h -= n
        h *= zr[:, :units]
        h += n
        if side == "b" and len(short):
            h[short[size[short] <= t]] = 0.0
        logits[:, t] = out @ h.T
    return logits


def position_probabilities(params: Params, rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Label probabilities at every position, (labels, width, rows); zero beyond a row's length."""
    logits = _logits(params, "f", rows, size)
    logits += _logits(params, "b", rows, size)
    logits += params["bias"][:, None, None]
    logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    if (size < rows.shape[1]).any():
        logits *= np.arange(rows.shape[1])[:, None] < size
    return logits


def _forward(params: Params, side: str, rows: np.ndarray, size: np.ndarray) -> list[tuple]:
    """Everything back-propagation needs, step by step in the order of reading."""
    units, width = len(params[f"{side}_n"]), rows.shape[1]
    h, steps = np.zeros((len(rows), units), params["bias"].dtype), []
    for t in range(width) if side == "f" else range(width - 1, -1, -1):
        column, live = rows[:, t], (size > t)[:, None]
        a_zr = params[f"{side}_in_zr"][column] + h @ params[f"{side}_zr"]
        zr = 0.5 + 0.5 * _squash(a_zr.copy(), np.empty_like(a_zr))
        z, r = zr[:, :units], zr[:, units:]
        u = h @ params[f"{side}_n"]
        a_n = params[f"{side}_in_n"][column] + r * u
        n = _squash(a_n.copy(), np.empty_like(a_n))
        new = (n + z * (h - n)) * live
        steps.append((t, h, a_zr, z, r, u, a_n, n, new))
        h = new
    return steps


def _backward(params: Params, side: str, rows: np.ndarray, size: np.ndarray, steps: list[tuple],
              d_logits: np.ndarray, grads: Params) -> None:
    """Back-propagation through time; ``d_logits`` is (rows, width, labels)."""
    out, u_zr, u_n = params[f"{side}_out"], params[f"{side}_zr"], params[f"{side}_n"]
    dh, read, d_read = np.zeros_like(steps[0][1]), [], []
    for t, h, a_zr, z, r, u, a_n, n, new in reversed(steps):
        grads[f"{side}_out"] += new.T @ d_logits[:, t]
        dh = (dh + d_logits[:, t] @ out.T) * (size > t)[:, None]
        d_an = dh * (1.0 - z) * _slope(a_n)
        d_zr = 0.5 * np.concatenate([dh * (h - n), d_an * u], axis=1) * _slope(a_zr)
        d_u = d_an * r
        grads[f"{side}_zr"] += h.T @ d_zr
        grads[f"{side}_n"] += h.T @ d_u
        read.append(rows[:, t])
        d_read.append(np.concatenate([d_zr, d_an], axis=1))
        dh = dh * z + d_zr @ u_zr.T + d_u @ u_n.T
    column, d = np.concatenate(read), np.concatenate(d_read)
    order = np.argsort(column, kind="stable")
    first = np.flatnonzero(np.diff(column[order], prepend=-1))
    sums = np.add.reduceat(d[order], first, axis=0)
    grads[f"{side}_in_zr"][column[order][first]] += sums[:, :2 * len(u_n)]
    grads[f"{side}_in_n"][column[order][first]] += sums[:, 2 * len(u_n):]


def loss_and_gradients(params: Params, rows: np.ndarray, size: np.ndarray, labels: np.ndarray) -> tuple[float, Params]:
    """Mean cross-entropy over all positions, each labelled as its row is, and its gradients."""
    grads = {k: np.zeros_like(v) for k, v in params.items()}
    ahead, behind = _forward(params, "f", rows, size), _forward(params, "b", rows, size)
    logits = np.stack([s[-1] @ params["f_out"] for s in ahead], axis=1) + params["bias"]
    logits += np.stack([s[-1] @ params["b_out"] for s in reversed(behind)], axis=1)
    logits -= logits.max(axis=2, keepdims=True)
    d = np.exp(logits)
    d /= d.sum(axis=2, keepdims=True)
    inside = np.arange(rows.shape[1]) < size[:, None]
    at_label = np.take_along_axis(d, labels[:, None, None], axis=2)[:, :, 0]
    positions = max(1, int(inside.sum()))
    loss = float(-(np.log(at_label + 1e-12) * inside).sum() / positions)
    d[np.arange(len(rows)), :, labels] -= 1.0
    d *= inside[:, :, None] / d.dtype.type(positions)
    grads["bias"] += d.sum(axis=(0, 1))
    _backward(params, "f", rows, size, ahead, d, grads)
    _backward(params, "b", rows, size, behind, d, grads)
    return loss, grads


@dataclass(frozen=True)
class Training:
    """Settings of the training; all are parameters of the caller."""
    size: int = 8
    width: int = 128
    batch: int = 128
    updates: int = 200
    rate: float = 0.02
    seed: int = 7


def train(rows: np.ndarray, size: np.ndarray, labels: np.ndarray, n_labels: int, how: Training) -> Params:
    """Adam with a falling rate over batches that hold every label equally often."""
    rng = np.random.default_rng(how.seed)
    params = initial(how.size, n_labels, rng)
    mean, square = ({k: np.zeros_like(v) for k, v in params.items()} for _ in range(2))
    by_label = [np.flatnonzero(labels == k) for k in range(n_labels)]
    by_label = [x for x in by_label if len(x)]
    for step in range(1, how.updates + 1):
        pick = np.concatenate([rng.choice(x, max(1, how.batch // len(by_label))) for x in by_label])
        _, grads = loss_and_gradients(params, rows[pick], size[pick], labels[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = how.rate * (1.0 - (step - 1) / how.updates)
        for k, g in grads.items():
            g = g / max(1.0, norm)
            mean[k] += 0.1 * (g - mean[k])
            square[k] += 0.01 * (g * g - square[k])
            params[k] -= rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)
    return params
