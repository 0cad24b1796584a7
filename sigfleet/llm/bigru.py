"""A bidirectional gated recurrent network over bytes, in numpy.

Each direction is a GRU whose input at a position is the byte itself (a row
of a table); the two hidden states of a position give the class scores of
that position. Trained with backpropagation through time on windows, applied
to windows of ``WINDOW`` bytes. Arrays are laid out (units, windows), so one
step handles all windows of a batch.
"""

from __future__ import annotations

import numpy as np

WINDOW = 128
F32 = np.float32


def new_model(hidden: int, classes: int, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p: dict[str, np.ndarray] = {}
    for d in "fb":
        p[f"x{d}"] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(F32)
        p[f"u{d}"] = rng.normal(0, 1 / np.sqrt(hidden), (3 * hidden, hidden)).astype(F32)
        p[f"c{d}"] = np.zeros((3 * hidden, 1), F32)
        p[f"o{d}"] = rng.normal(0, 1 / np.sqrt(hidden), (classes, hidden)).astype(F32)
    p["bias"] = np.zeros((classes, 1), F32)
    return p


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += F32(1)
    np.reciprocal(x, out=x)
    return x


def _gates(p, d: str, byte: np.ndarray, h: np.ndarray, hidden: int):
    """Update gate, reset gate, recurrent part and candidate of one step."""
    x = p[f"x{d}"].T.take(byte, axis=1)
    u = p[f"u{d}"] @ h
    u += p[f"c{d}"]
    zr = x[: 2 * hidden]
    zr += u[: 2 * hidden]
    _sigmoid(zr)
    un = u[2 * hidden :]
    n = x[2 * hidden :]
    n += zr[hidden:] * un
    np.tanh(n, out=n)
    return zr[:hidden], zr[hidden:], un, n


def position_probabilities(p, windows: np.ndarray) -> np.ndarray:
    """Class probabilities of every position: ``(length, classes, windows)``.

    ``windows`` is (length, windows) of bytes.
    """
    length, width = windows.shape
    hidden = p["uf"].shape[1]
    scores = np.empty((length, len(p["bias"]), width), F32)
    with np.errstate(over="ignore"):
        for d, order in (("f", range(length)), ("b", range(length - 1, -1, -1))):
            h = np.zeros((hidden, width), F32)
            for t in order:
                z, _, _, n = _gates(p, d, windows[t], h, hidden)
                h -= n
                h *= z
                h += n  # n + z (h - n)
                if d == "f":
                    np.matmul(p["of"], h, out=scores[t])
                else:
                    scores[t] += p["ob"] @ h
    scores += p["bias"]
    scores -= scores.max(axis=1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=1, keepdims=True)
    return scores


def _forward(p, d: str, windows: np.ndarray, hidden: int):
    length, width = windows.shape
    order = range(length) if d == "f" else range(length - 1, -1, -1)
    h = np.zeros((hidden, width), F32)
    steps = [None] * length
    for t in order:
        z, r, un, n = _gates(p, d, windows[t], h, hidden)
        new = n + z * (h - n)
        steps[t] = (h, z, r, un, n, new)
        h = new
    return steps


def _backward(p, d: str, windows, steps, dscore, hidden: int, grad) -> None:
    """Backpropagation through time of one direction."""
    length, width = windows.shape
    order = range(length - 1, -1, -1) if d == "f" else range(length)
    dh = np.zeros((hidden, width), F32)
    da_all = np.empty((length, width, 3 * hidden), F32)
    u, o = p[f"u{d}"], p[f"o{d}"]
    for t in order:
        h, z, r, un, n, new = steps[t]
        grad[f"o{d}"] += dscore[t] @ new.T
        dnew = dh + o.T @ dscore[t]
        dn = dnew * (1 - z) * (1 - n * n)
        dz = dnew * (h - n) * z * (1 - z)
        dr = dn * un * r * (1 - r)
        du = np.concatenate([dz, dr, dn * r])
        da_all[t] = np.concatenate([dz, dr, dn]).T
        grad[f"u{d}"] += du @ h.T
        grad[f"c{d}"] += du.sum(axis=1, keepdims=True)
        dh = dnew * z + u.T @ du
    flat = windows.reshape(-1)
    order = np.argsort(flat, kind="stable")
    first = np.flatnonzero(np.r_[True, flat[order][1:] != flat[order][:-1]])
    sums = np.add.reduceat(da_all.reshape(-1, 3 * hidden)[order], first, axis=0)
    grad[f"x{d}"][flat[order][first]] += sums


def gradients(p, windows: np.ndarray, labels: np.ndarray, used: np.ndarray):
    """Mean cross-entropy over the used positions, and its gradients."""
    hidden = p["uf"].shape[1]
    length, width = windows.shape
    steps = {d: _forward(p, d, windows, hidden) for d in "fb"}
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    score = np.stack(
        [p["of"] @ steps["f"][t][5] + p["ob"] @ steps["b"][t][5] + p["bias"] for t in range(length)]
    )
    score -= score.max(axis=1, keepdims=True)
    prob = np.exp(score)
    prob /= prob.sum(axis=1, keepdims=True)
    count = max(1.0, float(used.sum()))
    cols = np.arange(width)
    right = prob[:, labels, cols]
    loss = float(-(np.log(np.maximum(right, 1e-12)) * used).sum() / count)
    dscore = prob
    dscore[:, labels, cols] -= 1
    dscore *= (used / F32(count))[:, None, :]
    grad["bias"] += dscore.sum(axis=(0, 2))[:, None]
    for d in "fb":
        _backward(p, d, windows, steps[d], dscore, hidden, grad)
    return loss, grad


def train(
    windows: np.ndarray,
    labels: np.ndarray,
    used: np.ndarray,
    classes: int,
    hidden: int = 8,
    steps: int = 600,
    batch: int = 128,
    rate: float = 0.02,
    seed: int = 7,
) -> dict[str, np.ndarray]:
    """``steps`` batches of Adam, reshuffled when all windows have been used.

    ``windows`` and ``used`` are (length, windows).
    """
    p = new_model(hidden, classes, seed)
    rng = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    order = np.empty(0, int)
    for step in range(1, steps + 1):
        if len(order) < batch:
            order = np.concatenate([order, rng.permutation(windows.shape[1])])
        pick, order = order[:batch], order[batch:]
        _, grad = gradients(p, windows[:, pick], labels[pick], used[:, pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        clip = min(1.0, 1.0 / (norm + 1e-9))
        lr = rate * (1.0 - step / (steps + 1.0)) + 1e-4
        for k, g in grad.items():
            g *= F32(clip)
            m[k] += F32(0.1) * (g - m[k])
            s[k] += F32(0.01) * (g * g - s[k])
            p[k] -= F32(lr) * (m[k] / (1 - 0.9**step)).astype(F32) / (
                np.sqrt(s[k] / (1 - 0.99**step)).astype(F32) + F32(1e-8)
            )
    return p


def pooled(p, texts: list[bytes], batch_windows: int = 4096) -> np.ndarray:
    """Mean position probabilities of each text: ``(texts, classes)``.

    Texts are cut into windows, whole; an empty text has zeros. Windows of
    many texts run together.
    """
    classes = len(p["bias"])
    out = np.zeros((len(texts), classes))
    counts = np.array([-(-len(t) // WINDOW) for t in texts])
    starts = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(texts)), counts)
    for lo in range(0, int(starts[-1]), batch_windows):
        hi = min(lo + batch_windows, int(starts[-1]))
        data = np.zeros((hi - lo, WINDOW), np.uint8)
        size = np.zeros(hi - lo, np.int64)
        for i in range(owner[lo], owner[hi - 1] + 1):
            a, b = max(lo, int(starts[i])), min(hi, int(starts[i + 1]))
            if b <= a:
                continue
            part = texts[i][(a - starts[i]) * WINDOW : (b - starts[i]) * WINDOW]
            flat = data[a - lo : b - lo].reshape(-1)
            flat[: len(part)] = np.frombuffer(part, np.uint8)
            size[a - lo : b - lo] = np.minimum(
                WINDOW, len(part) - np.arange(b - a) * WINDOW
            )
        prob = position_probabilities(p, np.ascontiguousarray(data.T))
        used = np.arange(WINDOW)[:, None] < size[None, :]
        sums = np.einsum("tcw,tw->wc", prob, used.astype(F32))
        np.add.at(out, owner[lo:hi], sums)
    total = np.array([max(1, len(t)) for t in texts], float)
    return out / total[:, None]
