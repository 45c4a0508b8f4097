"""A character-level bidirectional LSTM with CRF transitions, in numpy: training and decoding of batches.

Tags are O and, for each kind, B (first character) and I (inside). All windows of a batch have one length.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np

#: Character ids: 0 beyond the text, 1 to 95 printable ASCII, then line ends, other white space, other letters, other.
CHARS = 100


def char_ids(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    out = np.full(len(code), 99, dtype=np.int64)
    out[code >= 0xAA] = 98
    out[(code == 9) | (code == 0xA0) | (code == 11) | (code == 12)] = 97
    out[(code == 10) | (code == 13)] = 96
    ascii_ = (code >= 32) & (code < 127)
    out[ascii_] = code[ascii_].astype(np.int64) - 31
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Weights:
    """into [2, CHARS, 4H], through [2, H, 4H] for both directions; out [2H, K]; CRF transitions [K, K] and first [K]."""

    into: np.ndarray
    through: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    move: np.ndarray
    first: np.ndarray


def initial(hidden: int, tags: int, rng: np.random.Generator) -> Weights:
    normal = lambda scale, *shape: (rng.normal(0, scale, shape)).astype(np.float32)
    w = Weights(normal(0.3, 2, CHARS, 4 * hidden), normal(0.3, 2, hidden, 4 * hidden), normal(0.3, 2 * hidden, tags),
                np.zeros(tags, np.float32), normal(0.1, tags, tags), np.zeros(tags, np.float32))
    w.into[:, :, hidden:2 * hidden] += 1  # the forget gate starts open
    return w


def states(w: Weights, x: np.ndarray, keep: bool = False):
    """Both directions over windows x [B, T]: hidden [2, T, B, H], the second one in reversed time; gates if kept."""
    n, steps = x.shape
    size = w.through.shape[1]
    order = np.stack([x.T, x.T[::-1]])
    hidden = np.zeros((2, steps, n, size), np.float32)
    h = np.zeros((2, n, size), np.float32)
    c = np.zeros_like(h)
    saved = []
    for t in range(steps):
        z = np.matmul(h, w.through)
        z[0] += w.into[0][order[0, t]]
        z[1] += w.into[1][order[1, t]]
        z[..., :3 * size] = sigmoid(z[..., :3 * size])
        g = np.tanh(z[..., 3 * size:])
        i, f, o = z[..., :size], z[..., size:2 * size], z[..., 2 * size:3 * size]
        before = c
        c = f * c + i * g
        tc = np.tanh(c)
        if keep:
            saved.append((i, f, o, g, before, tc, h))
        h = o * tc
        hidden[:, t] = h
    return hidden, saved, order


def emissions(w: Weights, x: np.ndarray) -> np.ndarray:
    """Tag scores [B, T, K] of windows x [B, T]."""
    hidden, _, _ = states(w, x)
    both = np.concatenate([hidden[0], hidden[1][::-1]], axis=-1)
    return np.ascontiguousarray((both @ w.out + w.out_bias).transpose(1, 0, 2))


def viterbi(w: Weights, scores: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """The best tag sequence of each row of scores [B, T, K], of its own length."""
    n, steps, tags = scores.shape
    best = scores[:, 0] + w.first
    back = np.zeros((steps, n, tags), np.int8)
    for t in range(1, steps):
        paths = best[:, :, None] + w.move
        back[t] = paths.argmax(axis=1)
        step = paths.max(axis=1) + scores[:, t]
        best = np.where((t < lengths)[:, None], step, best)
    out = []
    for k, size in enumerate(lengths):
        tags_ = np.empty(size, np.int8)
        tags_[-1] = best[k].argmax()
        for t in range(size - 1, 0, -1):
            tags_[t - 1] = back[t, k, tags_[t]]
        out.append(tags_)
    return out


def logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def crf_gradients(w: Weights, scores: np.ndarray, y: np.ndarray):
    """Loss per window and its gradients by scores, transitions and first tags (forward-backward)."""
    n, steps, tags = scores.shape
    alpha = np.empty_like(scores)
    beta = np.zeros_like(scores)
    alpha[:, 0] = scores[:, 0] + w.first
    for t in range(1, steps):
        alpha[:, t] = logsumexp(alpha[:, t - 1, :, None] + w.move, 1) + scores[:, t]
    for t in range(steps - 2, -1, -1):
        beta[:, t] = logsumexp(w.move + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
    total = logsumexp(alpha[:, -1], 1)
    marginal = np.exp(alpha + beta - total[:, None, None])
    pairs = np.exp(alpha[:, :-1, :, None] + w.move + (scores[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None])
    gold = np.eye(tags, dtype=np.float32)[y]
    path = (scores * gold).sum(axis=(1, 2)) + w.first[y[:, 0]] + w.move[y[:, :-1], y[:, 1:]].sum(axis=1)
    move = pairs.sum(axis=(0, 1))
    np.subtract.at(move, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
    return (total - path).mean(), (marginal - gold) / n, move / n, (marginal[:, 0] - gold[:, 0]).sum(axis=0) / n


def gradients(w: Weights, x: np.ndarray, y: np.ndarray) -> tuple[float, Weights]:
    hidden, saved, order = states(w, x, keep=True)
    both = np.concatenate([hidden[0], hidden[1][::-1]], axis=-1)
    scores = (both @ w.out + w.out_bias).transpose(1, 0, 2)
    loss, by_score, move, first = crf_gradients(w, np.ascontiguousarray(scores), y)
    by_score = by_score.transpose(1, 0, 2)
    size = w.through.shape[1]
    by_both = by_score @ w.out.T
    by_hidden = np.stack([by_both[..., :size], by_both[::-1, :, size:]])
    g = Weights(np.zeros_like(w.into), np.zeros_like(w.through), np.einsum("tbh,tbk->hk", both, by_score),
                by_score.sum(axis=(0, 1)), move, first)
    dh = np.zeros_like(hidden[:, 0])
    dc = np.zeros_like(dh)
    by_gate = np.empty((2, len(saved), x.shape[0], 4 * size), np.float32)
    for t in range(len(saved) - 1, -1, -1):
        i, f, o, gate, before, tc, h = saved[t]
        dh = dh + by_hidden[:, t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * gate * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o),
                             dc * i * (1 - gate * gate)], axis=-1)
        by_gate[:, t] = dz
        g.through += np.matmul(h.transpose(0, 2, 1), dz)
        dh = np.matmul(dz, w.through.transpose(0, 2, 1))
        dc = dc * f
    for d in (0, 1):  # the gradient of a table row is the sum over the places where its character stands
        places = np.argsort(order[d], axis=None, kind="stable")
        chars, starts = np.unique(order[d].ravel()[places], return_index=True)
        g.into[d][chars] = np.add.reduceat(by_gate[d].reshape(-1, 4 * size)[places], starts, axis=0)
    return float(loss), g


def train(x: np.ndarray, y: np.ndarray, tags: int, hidden: int, steps: int, batch: int, rate: float, seed: int) -> Weights:
    """Adam over random batches of labelled windows x, y [N, T]."""
    rng = np.random.default_rng(seed)
    w = initial(hidden, tags, rng)
    names = [f.name for f in fields(w)]
    first = {k: 0.0 for k in names}
    second = {k: 0.0 for k in names}
    for step in range(1, steps + 1):
        rows = rng.integers(0, len(x), batch)
        _, g = gradients(w, x[rows], y[rows])
        norm = np.sqrt(sum(float((getattr(g, k) ** 2).sum()) for k in names))
        now = rate * min(1.0, 1.6 * (1 - step / (steps + 1)))
        for k in names:
            d = getattr(g, k) * min(1.0, 5 / (norm + 1e-6))
            first[k] = 0.9 * first[k] + 0.1 * d
            second[k] = 0.99 * second[k] + 0.01 * d * d
            setattr(w, k, (getattr(w, k) - now * (first[k] / (1 - 0.9**step))
                           / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32))
    return w
