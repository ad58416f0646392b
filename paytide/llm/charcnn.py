"""A small character convolutional network in numpy.

Characters are embedded, one convolution runs over them, its responses are pooled by
maximum over three zones (left context, value, right context), and two dense layers give a
logit. Weights are drawn and batches are taken from a fixed seed.
"""

from __future__ import annotations

import numpy as np

LEFT, VALUE, RIGHT = 24, 48, 16
WIDTH = LEFT + VALUE + RIGHT
_SYMBOLS = 98  # padding, printable ASCII, line break or control, beyond ASCII
_DIM, _SPAN, _FILTERS, _HIDDEN = 8, 5, 24, 16


def window(text: str, start: int, end: int) -> bytes:
    """Codes of a candidate with its context; a long value keeps its two ends."""
    value = text[start:end]
    if len(value) > VALUE:
        value = value[: VALUE // 2] + value[-VALUE // 2 :]
    left = text[max(0, start - LEFT) : start]
    codes = [0] * (LEFT - len(left)) + _codes(left)
    codes += _codes(value) + [0] * (VALUE - len(value))
    right = _codes(text[end : end + RIGHT])
    return bytes(codes + right + [0] * (RIGHT - len(right)))


def _codes(text: str) -> list[int]:
    return [ord(c) - 31 if " " <= c <= "~" else (96 if c < " " else 97) for c in text]


def start_weights(seed: int) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return draw.normal(0, scale, shape)

    return {
        "embed": normal(_SYMBOLS, _DIM, scale=0.5),
        "conv": normal(_SPAN * _DIM, _FILTERS, scale=(2 / (_SPAN * _DIM)) ** 0.5),
        "conv_bias": np.zeros(_FILTERS),
        "hidden": normal(3 * _FILTERS, _HIDDEN, scale=(2 / (3 * _FILTERS)) ** 0.5),
        "hidden_bias": np.zeros(_HIDDEN),
        "out": normal(_HIDDEN, scale=_HIDDEN**-0.5),
        "out_bias": np.zeros(1),
    }


_ZONES = [(0, LEFT - _SPAN + 1), (LEFT - _SPAN // 2, LEFT + VALUE - _SPAN // 2), (LEFT + VALUE - 2, WIDTH - _SPAN + 1)]


def _forward(w: dict, x: np.ndarray) -> tuple:
    n = len(x)
    emb = w["embed"][x]
    steps = WIDTH - _SPAN + 1
    cols = np.concatenate([emb[:, i : i + steps] for i in range(_SPAN)], axis=2)
    act = np.maximum(cols @ w["conv"] + w["conv_bias"], 0)
    pooled = np.empty((n, 3, _FILTERS))
    where = np.empty((n, 3, _FILTERS), np.int64)
    for z, (lo, hi) in enumerate(_ZONES):
        where[:, z] = act[:, lo:hi].argmax(axis=1) + lo
        pooled[:, z] = act[:, lo:hi].max(axis=1)
    flat = pooled.reshape(n, -1)
    hidden = np.maximum(flat @ w["hidden"] + w["hidden_bias"], 0)
    return hidden @ w["out"] + w["out_bias"][0], (cols, act, where, flat, hidden)


def logits(w: dict, x: np.ndarray) -> np.ndarray:
    if not len(x):
        return np.zeros(0)
    return np.concatenate([_forward(w, x[i : i + 512])[0] for i in range(0, len(x), 512)])


def _gradients(w: dict, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    logit, (cols, act, where, flat, hidden) = _forward(w, x)
    n = len(x)
    d = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / n
    d_hidden = np.outer(d, w["out"]) * (hidden > 0)
    d_pooled = (d_hidden @ w["hidden"].T).reshape(n, 3, _FILTERS)
    d_act = np.zeros_like(act)
    rows, filters = np.arange(n)[:, None], np.arange(_FILTERS)[None]
    for z in range(3):
        np.add.at(d_act, (rows, where[:, z], filters), d_pooled[:, z])
    d_act *= act > 0
    d_cols = d_act @ w["conv"].T
    d_emb = np.zeros((n, WIDTH, _DIM))
    steps = cols.shape[1]
    for i in range(_SPAN):
        d_emb[:, i : i + steps] += d_cols[:, :, i * _DIM : (i + 1) * _DIM]
    d_table = np.zeros_like(w["embed"])
    np.add.at(d_table, x, d_emb)
    return {
        "embed": d_table,
        "conv": np.tensordot(cols, d_act, axes=([0, 1], [0, 1])),
        "conv_bias": d_act.sum(axis=(0, 1)),
        "hidden": flat.T @ d_hidden,
        "hidden_bias": d_hidden.sum(axis=0),
        "out": hidden.T @ d,
        "out_bias": np.array([d.sum()]),
    }


#: Adam steps of a training, at the least.
STEPS = 300


def train(x: np.ndarray, y: np.ndarray, seed: int, steps: int = STEPS, batch: int = 128) -> dict:
    """Weights after `steps` Adam steps on balanced batches of labelled windows."""
    return adam(x, y, seed, steps, batch, start_weights(seed))[0]


def adam(x: np.ndarray, y: np.ndarray, seed: int, steps: int, batch: int, w: dict, moments=None, done: int = 0, drawn=None):
    """Weights, Adam's moments and the state of the draws after `steps` more steps on
    balanced batches, from weights `w`, `moments`, `done` steps before and draws in state
    `drawn`. A set of one label gives batches of it."""
    w = {k: v.copy() for k, v in w.items()}
    draw = np.random.default_rng(seed + 1)
    if drawn is not None:
        draw.bit_generator.state = drawn
    yes, no = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    yes, no = (yes if len(yes) else no), (no if len(no) else yes)
    mean, square = moments or ({k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()})
    mean, square = {k: v.copy() for k, v in mean.items()}, {k: v.copy() for k, v in square.items()}
    for step in range(done + 1, done + steps + 1):
        at = np.concatenate([draw.choice(yes, batch // 2), draw.choice(no, batch // 2)])
        for k, g in _gradients(w, x[at], y[at]).items():
            mean[k] += 0.1 * (g - mean[k])
            square[k] += 0.001 * (g * g - square[k])
            w[k] -= 0.01 * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return w, (mean, square), draw.bit_generator.state


#: Slopes a calibration may have; beyond them it says nothing about the logits.
SLOPES = (0.05, 20.0)


def calibrate(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of Platt scaling on smoothed labels, by Newton steps with a line
    search, so that a separable set does not drive them off. The slope stays within
    `SLOPES`; logits that do not rise with the label are left as they are."""
    pos, neg = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))

    def loss(a: float, b: float) -> float:
        z = a * logit + b
        return float((np.logaddexp(0, z) - target * z).sum() + 5e-4 * a * a)

    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * logit + b, -500, 500)))
        g = np.array([((p - target) * logit).sum() + 1e-3 * a, (p - target).sum()])
        w = p * (1 - p)
        h = np.array([[(w * logit * logit).sum() + 1e-3, (w * logit).sum()], [(w * logit).sum(), w.sum()]])
        step = np.linalg.solve(h + 1e-6 * np.eye(2), g)
        now, rate = loss(a, b), 1.0
        while rate > 1e-6 and not loss(a - rate * step[0], b - rate * step[1]) < now:
            rate /= 2
        if rate <= 1e-6:
            break
        a, b = a - rate * step[0], b - rate * step[1]
    if not a > 0:
        return 1.0, 0.0
    return float(np.clip(a, *SLOPES)), float(b)


def recall_threshold(p: np.ndarray, y: np.ndarray, recall: float) -> float:
    """The probability that keeps `recall` of the positives at the best precision."""
    if not (y == 1).any():
        return float("inf")
    positives = np.sort(p[y == 1])
    highest = positives[int(np.floor((1 - recall) * len(positives)))]
    options = np.unique(np.append(p[p <= highest], highest))
    precision = [(y[p >= t] == 1).mean() for t in options]
    best = np.flatnonzero(np.array(precision) >= max(precision) - 1e-12)
    return float(options[best[-1]])
