"""A character tagger: bidirectional LSTM with CRF transitions, in numpy.

Arrays are time-major: ``[time, sequence, feature]``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: ASCII by code, anything else 128, padding 0.
ALPHABET = 129


def char_ids(text: str, size: int) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ids = np.zeros(size, dtype=np.int64)
    ids[: len(codes)] = np.minimum(codes, ALPHABET - 1)
    return ids


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _lstm(
    x: np.ndarray, w: np.ndarray, b: np.ndarray, keep: bool = True
) -> tuple[np.ndarray, list]:
    """Outputs, and what the gradients need of each step if ``keep`` is on."""
    steps, n, _ = x.shape
    size = w.shape[1] // 4
    h, c = np.zeros((n, size), x.dtype), np.zeros((n, size), x.dtype)
    out, kept = np.empty((steps, n, size), x.dtype), []
    from_x = x @ w[: x.shape[2]] + b
    for t in range(steps):
        gates = from_x[t] + h @ w[x.shape[2] :]
        i, f, o = np.split(_sigmoid(gates[:, : 3 * size]), 3, axis=1)
        g = np.tanh(gates[:, 3 * size :])
        before, c = c, f * c + i * g
        squashed = np.tanh(c)
        if keep:
            kept.append((i, f, o, g, before, squashed, h))
        h = o * squashed
        out[t] = h
    return out, kept


def _lstm_back(
    x: np.ndarray, w: np.ndarray, kept: list, dout: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of the input, the weights and the bias."""
    steps, n, width = x.shape
    size = w.shape[1] // 4
    dw, db, dx = np.zeros_like(w), np.zeros(w.shape[1], w.dtype), np.empty_like(x)
    dh, dc = np.zeros((n, size), w.dtype), np.zeros((n, size), w.dtype)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, before, squashed, h = kept[t]
        dh = dh + dout[t]
        dc = dc + dh * o * (1 - squashed**2)
        gates = np.concatenate(
            [
                dc * g * i * (1 - i),
                dc * before * f * (1 - f),
                dh * squashed * o * (1 - o),
                dc * i * (1 - g**2),
            ],
            axis=1,
        )
        dw[:width] += x[t].T @ gates
        dw[width:] += h.T @ gates
        db += gates.sum(axis=0)
        dx[t] = gates @ w[:width].T
        dh = gates @ w[width:].T
        dc = dc * f
    return dx, dw, db


def _forward_backward(emit: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
    """Log weights of what comes up to and after each tag, and of all paths."""
    steps = len(emit)
    up, after = np.empty_like(emit), np.empty_like(emit)
    up[0], after[-1] = emit[0], 0
    for t in range(1, steps):
        up[t] = emit[t] + _log_sum(up[t - 1][:, :, None] + step, axis=1)
    for t in range(steps - 2, -1, -1):
        after[t] = _log_sum(step + (emit[t + 1] + after[t + 1])[:, None, :], axis=2)
    return up, after, _log_sum(up[-1], axis=1)


@dataclass
class Tagger:
    """``tags`` numbers of tags, 0 the tag of anything unmarked."""

    weights: dict[str, np.ndarray]

    @classmethod
    def new(cls, tags: int, embed: int = 16, hidden: int = 16, seed: int = 1) -> Tagger:
        draw = np.random.default_rng(seed)
        scaled = lambda *shape: draw.normal(0, 1 / np.sqrt(shape[0]), shape)
        bias = np.zeros(4 * hidden)
        bias[hidden : 2 * hidden] = 1
        return cls(
            {
                "chars": draw.normal(0, 0.3, (ALPHABET, embed)),
                "w_ahead": scaled(embed + hidden, 4 * hidden),
                "b_ahead": bias.copy(),
                "w_back": scaled(embed + hidden, 4 * hidden),
                "b_back": bias.copy(),
                "w_out": scaled(2 * hidden, tags),
                "b_out": np.zeros(tags),
                "step": np.zeros((tags, tags)),
            }
        )

    def single(self) -> Tagger:
        return Tagger({k: v.astype(np.float32) for k, v in self.weights.items()})

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """Tag scores ``[time, sequence, tag]`` of character ids ``[sequence, time]``."""
        return self._run(ids, keep=False)[0]

    def _run(self, ids: np.ndarray, keep: bool = True) -> tuple:
        w = self.weights
        x = w["chars"][ids.T]
        ahead, kept_a = _lstm(x, w["w_ahead"], w["b_ahead"], keep)
        back, kept_b = _lstm(x[::-1], w["w_back"], w["b_back"], keep)
        both = np.concatenate([ahead, back[::-1]], axis=2)
        return both @ w["w_out"] + w["b_out"], x, both, kept_a, kept_b

    def loss(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of tag sequences, and its gradients."""
        w = self.weights
        emit, x, both, kept_a, kept_b = self._run(ids)
        step, n = w["step"], len(ids)
        up, after, total = _forward_backward(emit, step)
        gold = tags.T
        rows = np.arange(n)
        path = sum(emit[t, rows, gold[t]] for t in range(len(gold)))
        path = path + sum(step[gold[t - 1], gold[t]] for t in range(1, len(gold)))
        demit = np.exp(up + after - total[None, :, None])
        dstep = np.zeros_like(step)
        for t in range(1, len(gold)):
            pair = (
                up[t - 1][:, :, None] + step + (emit[t] + after[t])[:, None, :]
            ) - total[:, None, None]
            dstep += np.exp(pair).sum(axis=0)
            np.add.at(dstep, (gold[t - 1], gold[t]), -1)
        for t in range(len(gold)):
            demit[t, rows, gold[t]] -= 1
        demit, dstep = demit / n, dstep / n
        dboth = demit @ w["w_out"].T
        size = both.shape[2] // 2
        dxa, dwa, dba = _lstm_back(x, w["w_ahead"], kept_a, dboth[:, :, :size])
        dxb, dwb, dbb = _lstm_back(x[::-1], w["w_back"], kept_b, dboth[::-1, :, size:])
        dchars = np.zeros_like(w["chars"])
        np.add.at(dchars, ids.T, dxa + dxb[::-1])
        grads = {
            "chars": dchars,
            "w_ahead": dwa,
            "b_ahead": dba,
            "w_back": dwb,
            "b_back": dbb,
            "w_out": np.einsum("tni,tnk->ik", both, demit),
            "b_out": demit.sum(axis=(0, 1)),
            "step": dstep,
        }
        return float((total - path).mean()), grads

    def train(
        self, ids: np.ndarray, tags: np.ndarray, steps: int, batch: int = 32, seed: int = 2
    ) -> float:
        """Adam over shuffled batches, ``steps`` of them and what is left of the last
        round; the mean loss of that round."""
        draw = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        t, last = 0, 0.0
        while t < steps:
            losses = []
            for part in np.array_split(draw.permutation(len(ids)), max(1, len(ids) // batch)):
                loss, grads = self.loss(ids[part], tags[part])
                losses.append(loss)
                t += 1
                for k, g in grads.items():
                    g = np.clip(g, -5, 5)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g**2
                    rate = 0.01 * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
                    self.weights[k] -= rate * first[k] / (np.sqrt(second[k]) + 1e-8)
            last = float(np.mean(losses))
        return last

    def decode(self, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags ``[time, sequence]`` of tag scores and their probabilities."""
        step = self.weights["step"]
        steps, n, k = emit.shape
        best, came = emit[0], np.empty((steps, n, k), dtype=np.int64)
        for t in range(1, steps):
            through = best[:, :, None] + step
            came[t] = through.argmax(axis=1)
            best = emit[t] + through.max(axis=1)
        tags = np.empty((steps, n), dtype=np.int64)
        tags[-1] = best.argmax(axis=1)
        rows = np.arange(n)
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = came[t, rows, tags[t]]
        up, after, total = _forward_backward(emit, step)
        sure = np.exp(up + after - total[None, :, None])
        return tags, np.take_along_axis(sure, tags[:, :, None], axis=2)[:, :, 0]
