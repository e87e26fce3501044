"""Character-level bidirectional LSTM with CRF transitions, forward and training in numpy.

Tags are O and, for each kind, B (first character) and I (a further one).
"""

from __future__ import annotations

import numpy as np

CLASSES = 100  # 0: beyond the text; 1-95: printable ASCII; 96: line break; 97: other letter; 98: other blank; 99: rest
BARRED = -1e4


def classes(text: str) -> np.ndarray:
    """Class of every character of a text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where((codes >= 32) & (codes < 127), codes - 31, 99).astype(np.uint8)
    out[(codes == 10) | (codes == 13)] = 96
    out[(codes == 9) | (codes == 0xA0)] = 98
    far = np.flatnonzero(codes > 0xBF)
    if len(far):
        out[far] = [97 if text[i].isalpha() else 99 for i in far]
    return out


def allowed(kinds: int) -> np.ndarray:
    """Tag pairs that may follow each other: I of a kind only after B or I of it."""
    n = 1 + 2 * kinds
    ok = np.ones((n, n), bool)
    for k in range(kinds):
        ok[:, 2 + 2 * k] = False
        ok[1 + 2 * k, 2 + 2 * k] = ok[2 + 2 * k, 2 + 2 * k] = True
    return ok


class Tagger:
    """Parameters: w (2, CLASSES, 4H) input rows, u (2, H, 4H), out (2H, tags), bias, trans (tags, tags)."""

    def __init__(self, kinds: int, hidden: int = 12, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.hidden, self.tags, self.ok = hidden, 1 + 2 * kinds, allowed(kinds)
        g = 4 * hidden
        self.p = {
            "w": rng.normal(0, 0.3, (2, CLASSES, g)).astype(np.float32),
            "u": rng.normal(0, 0.25, (2, hidden, g)).astype(np.float32),
            "out": rng.normal(0, 0.3, (2 * hidden, self.tags)).astype(np.float32),
            "bias": np.zeros(self.tags, np.float32),
            "trans": np.zeros((self.tags, self.tags), np.float32),
        }
        self.p["w"][:, :, hidden:2 * hidden] += 1  # gates start open to the past

    def _states(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Hidden states (B, T, 2H) of windows x (B, T); ``keep`` collects what the gradient needs."""
        n, length = x.shape
        h, c = np.zeros((2, n, self.hidden), np.float32), np.zeros((2, n, self.hidden), np.float32)
        both = np.stack([x, x[:, ::-1]])
        out = np.zeros((2, n, length, self.hidden), np.float32)
        m = self.hidden
        for t in range(length):
            z = np.matmul(h, self.p["u"])
            z[0] += self.p["w"][0][both[0, :, t]]
            z[1] += self.p["w"][1][both[1, :, t]]
            gate = 1 / (1 + np.exp(-z[:, :, :3 * m]))
            i, f, o = gate[:, :, :m], gate[:, :, m:2 * m], gate[:, :, 2 * m:]
            g = np.tanh(z[:, :, 3 * m:])
            before, last = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[:, :, t] = h
            if keep is not None:
                keep.append((i, f, o, g, before, tc, last, both[:, :, t]))
        return np.concatenate([out[0], out[1][:, ::-1]], axis=2)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Tag scores (B, T, tags)."""
        return self._states(x) @ self.p["out"] + self.p["bias"]

    def _trans(self) -> np.ndarray:
        return np.where(self.ok, self.p["trans"], BARRED)

    def _start(self) -> np.ndarray:
        start = np.zeros(self.tags)
        start[2::2] = BARRED
        return start

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of tags y and its gradient."""
        n, length = x.shape
        keep: list = []
        states = self._states(x, keep)
        e = (states @ self.p["out"] + self.p["bias"]).astype(np.float64)
        trans, start = self._trans(), self._start()

        def add(a, axis):
            top = a.max(axis=axis, keepdims=True)
            return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)

        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0] + start
        for t in range(1, length):
            alpha[:, t] = e[:, t] + add(alpha[:, t - 1][:, :, None] + trans, 1)
        for t in range(length - 2, -1, -1):
            beta[:, t] = add(trans[None] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        total = add(alpha[:, -1], 1)
        rows = np.arange(n)
        gold = e[rows[:, None], np.arange(length), y].sum(1) + trans[y[:, :-1], y[:, 1:]].sum(1)
        de = np.exp(alpha + beta - total[:, None, None])
        de[rows[:, None], np.arange(length), y] -= 1
        dtrans = np.zeros_like(trans)
        for t in range(1, length):
            dtrans += np.exp(alpha[:, t - 1][:, :, None] + trans + (e[:, t] + beta[:, t])[:, None, :] - total[:, None, None]).sum(0)
        np.add.at(dtrans, (y[:, :-1], y[:, 1:]), -1)
        de = (de / n).astype(np.float32)
        grad = {"trans": np.where(self.ok, dtrans / n, 0).astype(np.float32), "bias": de.sum((0, 1)),
                "out": np.tensordot(states, de, ([0, 1], [0, 1])), "w": np.zeros_like(self.p["w"]), "u": np.zeros_like(self.p["u"])}
        ds = de @ self.p["out"].T
        m = self.hidden
        back = np.stack([ds[:, :, :m], ds[:, ::-1, m:]])
        dh, dc = np.zeros((2, n, m), np.float32), np.zeros((2, n, m), np.float32)
        ut = self.p["u"].transpose(0, 2, 1)
        for t in range(length - 1, -1, -1):
            i, f, o, g, before, tc, last, chars = keep[t]
            dh = dh + back[:, :, t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=2)
            grad["u"] += np.matmul(last.transpose(0, 2, 1), dz)
            for d in range(2):
                np.add.at(grad["w"][d], chars[d], dz[d])
            dh, dc = np.matmul(dz, ut), dc * f
        return float((total - gold).mean()), grad

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 10, batch: int = 48, rate: float = 0.02, seed: int = 3) -> float:
        """Adam over shuffled batches; returns the loss of the last epoch."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, loss = 0, 0.0
        for epoch in range(epochs):
            losses = []
            order = rng.permutation(len(x))
            for b in range(0, len(x), batch):
                at = order[b:b + batch]
                value, grad = self.gradient(x[at], y[at])
                losses.append(value)
                step += 1
                lr = rate * (1 - epoch / epochs)
                for k, g in grad.items():
                    m[k] += 0.1 * (g - m[k])
                    s[k] += 0.01 * (g * g - s[k])
                    self.p[k] -= lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-7)
            loss = float(np.mean(losses))
        return loss

    def best(self, e: np.ndarray) -> np.ndarray:
        """Tags of the best path through scores (T, tags) of one stretch of text."""
        trans, n = self._trans(), len(e)
        score = e[0] + self._start()
        back = np.zeros((n, self.tags), np.int8)
        for t in range(1, n):
            both = score[:, None] + trans
            back[t] = both.argmax(0)
            score = both.max(0) + e[t]
        tags = np.zeros(n, np.int8)
        tags[-1] = score.argmax()
        for t in range(n - 1, 0, -1):
            tags[t - 1] = back[t, tags[t]]
        return tags
