"""A small gated recurrent language model in numpy, with a class-factored output.

The state follows h' = h + z * (c - h): the candidate c = tanh(X[token] + h U) and the gate
z = sigmoid(Z[token] + u * h) read the token from tables, and both read the state, the candidate
through a full matrix. The probability of the next token is P(class | h), times
P(token | class, h) where the class has a softmax of its own. Training cuts the gradient at the
window's start, the state goes on.

Documents run side by side in lanes; a lane resets its state where a document starts, so a document
of any length keeps its state from its first token to its end.
"""

from __future__ import annotations

import ctypes
import heapq

import numpy as np

STATE = 24
WINDOW = 32
SAFE = 60.0     # scores whose exponentials, and sums of them, fit a float32


class Net:
    """Parameters in one flat float32 vector, with named views."""

    def __init__(self, n_inputs: int, n_classes: int, n_inner: int, inner: int,
                 flat: np.ndarray | None = None):
        h = STATE
        self.shape = {"Z": (n_inputs, h), "X": (n_inputs, h), "u": (h,), "U": (h, h),
                      "C": (h, n_classes), "cb": (n_classes,), "W": (n_inner, h, inner),
                      "wb": (n_inner, inner)}
        size = sum(int(np.prod(s)) for s in self.shape.values())
        if flat is None:
            rng = np.random.default_rng(7)
            flat = rng.normal(0, 0.1, size).astype(np.float32)
        self.flat, self.n_inner = flat, n_inner
        self.view = self.views(flat)

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.shape.items():
            n = int(np.prod(shape))
            out[name] = flat[at:at + n].reshape(shape)
            at += n
        return out

    def states(self, ids: np.ndarray, fresh: np.ndarray, h: np.ndarray):
        """States before each token of a window, gates, candidates, and the state after it."""
        v = self.view
        gate, cand = v["Z"][ids], v["X"][ids]
        before = np.empty_like(gate)
        starts = fresh.any(1)
        for t in range(len(ids)):
            if starts[t]:
                h = h * ~fresh[t, :, None]
            before[t] = h
            z, c = gate[t], cand[t]
            z += v["u"] * h
            np.negative(z, out=z)
            np.exp(z, out=z)
            z += 1
            np.reciprocal(z, out=z)
            c += h @ v["U"]
            np.tanh(c, out=c)
            h = h + z * (c - h)
        return before, gate, cand, h

    def outputs(self, flat_h: np.ndarray, cls: np.ndarray, inner: np.ndarray, grad: bool):
        """Natural log probabilities of the targets; with `grad`, also the derivatives of their
        negative sum."""
        v = self.view
        score = flat_h @ v["C"]
        score += v["cb"]
        # states lie within -1 and 1, which bounds the scores
        small = max(np.abs(v["C"]).sum(0).max() + np.abs(v["cb"]).max(),
                    np.abs(v["W"]).sum(1).max() + np.abs(v["wb"]).max()) < SAFE
        logp, p = _pick(score, cls, grad, small)
        g, dh = ({}, None)
        if grad:
            g["C"], g["cb"] = flat_h.T @ p, p.sum(0)
            dh = p @ v["C"].T
            g["W"], g["wb"] = np.zeros_like(v["W"]), np.zeros_like(v["wb"])
        order = np.argsort(cls.astype(np.int16), kind="stable")
        edge = np.searchsorted(cls[order], np.arange(self.n_inner + 1))
        for c in range(self.n_inner):
            rows = order[edge[c]:edge[c + 1]]
            if not len(rows):
                continue
            own = flat_h[rows]
            lp, q = _pick(own @ v["W"][c] + v["wb"][c], inner[rows], grad, small)
            logp[rows] += lp
            if grad:
                g["W"][c], g["wb"][c] = own.T @ q, q.sum(0)
                dh[rows] += q @ v["W"][c].T
        return logp, g, dh

    def gradient(self, ids, fresh, h, cls, inner, weight):
        """Gradient of the mean negative log probability of a window, and the state after it."""
        v = self.view
        before, gate, cand, after = self.states(ids, fresh, h)
        steps, lanes, width = before.shape
        flat = before.reshape(-1, width)
        used = np.flatnonzero(weight.reshape(-1))
        _, g, du_h = self.outputs(flat[used], cls.reshape(-1)[used], inner.reshape(-1)[used], True)
        out = np.zeros_like(flat)
        out[used] = du_h
        out = out.reshape(before.shape)
        d_gate, d_cand = (cand - before) * gate * (1 - gate), gate * (1 - cand * cand)
        dh, keep, back = np.zeros_like(h), 1 - gate, np.ascontiguousarray(v["U"].T)
        starts = fresh.any(1)
        for t in range(steps - 1, -1, -1):
            da, dc = d_gate[t], d_cand[t]
            da *= dh
            dc *= dh
            dh *= keep[t]
            dh += da * v["u"]
            dh += dc @ back
            dh += out[t]
            if starts[t]:
                dh *= ~fresh[t, :, None]
        d_gate, d_cand = d_gate.reshape(-1, width), d_cand.reshape(-1, width)
        g["u"], g["U"] = (d_gate * flat).sum(0), flat.T @ d_cand
        seen = ids.reshape(-1).astype(np.int16)     # few inputs: sorted by radix
        order = np.argsort(seen, kind="stable")
        names, first = np.unique(seen[order], return_index=True)
        total = np.zeros(len(self.flat), np.float32)
        into = self.views(total)
        for name, d in (("Z", d_gate), ("X", d_cand)):
            into[name][names] = np.add.reduceat(d[order], first, axis=0)
        for name, d in g.items():
            into[name][...] = d
        return total / max(1, len(used)), after


def keep_freed_memory() -> None:
    """Let the process keep the memory of freed arrays, as each window takes the same sizes again.
    Without a C library that can, nothing changes but the time."""
    try:
        set_option = ctypes.CDLL(None).mallopt
    except (AttributeError, OSError, TypeError):
        return
    for option in (-1, -3):     # fixed values: M_TRIM_THRESHOLD, M_MMAP_THRESHOLD
        set_option(option, 1 << 26)


def _pick(score: np.ndarray, target: np.ndarray, grad: bool, small: bool):
    """Log softmax at the targets; with `grad`, the scores become softmax minus one-hot."""
    if not small:
        score -= score.max(1, keepdims=True)
    rows = np.arange(len(target))
    at = score[rows, target]
    np.exp(score, out=score)
    total = score @ np.ones(score.shape[1], np.float32)
    logp = at - np.log(total)
    if grad:
        score *= (1 / total)[:, None]
        score[rows, target] -= 1
    return logp, score


def lanes_of(docs: list[np.ndarray], lanes: int):
    """Documents dealt to lanes, the longest first to the shortest lane: (steps x lanes) arrays of
    token id, document number (-1: padding) and whether a document starts."""
    # no more lanes than the longest document can keep busy
    longest = max(1, max(map(len, docs)))
    lanes = max(1, min(lanes, len(docs), -(-sum(map(len, docs)) // longest)))
    load, plan = [(0, k) for k in range(lanes)], [[] for _ in range(lanes)]
    for d in sorted(range(len(docs)), key=lambda d: (-len(docs[d]), d)):
        n, k = heapq.heappop(load)
        plan[k].append(d)
        heapq.heappush(load, (n + len(docs[d]), k))
    steps = max(n for n, _ in load)
    ids = np.zeros((steps, lanes), np.int32)
    doc = np.full((steps, lanes), -1, np.int32)
    fresh = np.zeros((steps, lanes), bool)
    for k, own in enumerate(plan):
        at = 0
        for d in own:
            n = len(docs[d])
            ids[at:at + n, k], doc[at:at + n, k], fresh[at, k] = docs[d], d, True
            at += n
    return ids, doc, fresh


class Adam:
    def __init__(self, net: Net, rate: float):
        self.net, self.rate, self.n = net, rate, 0
        self.mean, self.square = np.zeros_like(net.flat), np.zeros_like(net.flat)

    def step(self, g: np.ndarray) -> None:
        self.n += 1
        norm = float(np.linalg.norm(g))
        if norm > 1.0:
            g = g / norm
        self.mean += 0.1 * (g - self.mean)
        self.square += 0.01 * (g * g - self.square)
        fix = np.sqrt(1 - 0.99 ** self.n) / (1 - 0.9 ** self.n)
        self.net.flat -= self.rate * fix * self.mean / (np.sqrt(self.square) + 1e-7)


def train(net: Net, docs: list[np.ndarray], classes: np.ndarray, inner: np.ndarray,
          optimizer: Adam, lanes: int = 256) -> int:
    """One pass over whole documents (token ids). Returns the number of tokens."""
    if not docs:
        return 0
    keep_freed_memory()
    ids, doc, fresh = lanes_of(docs, lanes)
    h = np.zeros((ids.shape[1], STATE), np.float32)
    for t in range(0, len(ids), WINDOW):
        part = slice(t, t + WINDOW)
        i = ids[part]
        g, h = net.gradient(i, fresh[part], h, classes[i], inner[i], doc[part] >= 0)
        optimizer.step(g)
    return int((doc >= 0).sum())


def log_likelihood(net: Net, docs: list[np.ndarray], classes: np.ndarray, inner: np.ndarray,
                   lanes: int = 256) -> np.ndarray:
    """Natural log probability of each whole document."""
    total = np.zeros(len(docs))
    if not docs:
        return total
    keep_freed_memory()
    ids, doc, fresh = lanes_of(docs, lanes)
    h = np.zeros((ids.shape[1], STATE), np.float32)
    for t in range(0, len(ids), WINDOW):
        i, d = ids[t:t + WINDOW], doc[t:t + WINDOW].reshape(-1)
        before, _, _, h = net.states(i, fresh[t:t + WINDOW], h)
        used = np.flatnonzero(d >= 0)
        target = i.reshape(-1)[used]
        logp, _, _ = net.outputs(before.reshape(-1, STATE)[used], classes[target], inner[target], False)
        total += np.bincount(d[used], logp, minlength=len(docs))
    return total
