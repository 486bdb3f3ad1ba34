"""A bidirectional gated recurrent network over bytes, in numpy: labels every byte position of a text.

Forward and backward states read the bytes; a linear layer on both gives each position's language
log-probabilities.  Trained by backpropagation through time with Adam; the embedding is folded into the input
weights (one row of gate inputs per byte)."""

from __future__ import annotations

import numpy as np

PAD = 0


def encode(texts: list[str]) -> list[np.ndarray]:
    """UTF-8 bytes of each text."""
    return [np.frombuffer(t.encode("utf-8", "replace"), dtype=np.uint8) for t in texts]


def padded(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(time, batch) bytes and lengths."""
    lengths = np.array([len(s) for s in seqs], dtype=np.int64)
    out = np.zeros((max(1, int(lengths.max(initial=1))), len(seqs)), dtype=np.uint8)
    for j, s in enumerate(seqs):
        out[: len(s), j] = s
    return out, lengths


def _reverse(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each column turned round within its length."""
    t = np.arange(x.shape[0])[:, None]
    return np.take_along_axis(x, np.where(t < lengths, lengths - 1 - t, t), axis=0)


class BiGRU:
    """Weights: ``in_*`` (256, 3H) byte to gate inputs, ``rec_*`` (H, 3H), ``out`` (2H, K), ``bias`` (K)."""

    def __init__(self, labels: int, hidden: int = 12, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.hidden, self.labels = hidden, labels
        self.w = {}
        for d in ("f", "b"):
            self.w[f"in_{d}"] = (rng.standard_normal((256, 3 * hidden)) * 0.3).astype(np.float32)
            self.w[f"rec_{d}"] = (rng.standard_normal((hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32)
        self.w["out"] = (rng.standard_normal((2 * hidden, labels)) / np.sqrt(hidden)).astype(np.float32)
        self.w["bias"] = np.zeros(labels, dtype=np.float32)

    # ---- one direction.  Gates in the order z, r (sigmoid by tanh) and candidate.
    def _run(self, x: np.ndarray, d: str, keep: bool):
        H, (T, B) = self.hidden, x.shape
        gates, rec = self.w[f"in_{d}"], self.w[f"rec_{d}"]
        rec_zr, rec_c = np.ascontiguousarray(rec[:, : 2 * H]), np.ascontiguousarray(rec[:, 2 * H :])
        h = np.zeros((B, H), dtype=np.float32)
        states = np.empty((T, B, H), dtype=np.float32)
        saved = [] if keep else None
        for t in range(T):
            g = gates[x[t]]
            zr = g[:, : 2 * H] + h @ rec_zr
            np.tanh(np.multiply(zr, 0.5, out=zr), out=zr)
            zr *= 0.5
            zr += 0.5
            z, r = zr[:, :H], zr[:, H:]
            rh = r * h
            c = np.tanh(g[:, 2 * H :] + rh @ rec_c)
            new = h + z * (c - h)
            if keep:
                saved.append((h, z, r, rh, c))
            h = states[t] = new
        return states, saved

    def _logits(self, x: np.ndarray, lengths: np.ndarray, keep: bool = False):
        xb = _reverse(x, lengths)
        f, sf = self._run(x, "f", keep)
        b, sb = self._run(xb, "b", keep)
        H = self.hidden
        y = f @ self.w["out"][:H]
        yb = b @ self.w["out"][H:]
        t = np.arange(x.shape[0])[:, None]
        y += np.take_along_axis(yb, np.where(t < lengths, lengths - 1 - t, t)[:, :, None], axis=0)
        y += self.w["bias"]
        return y, (f, b, sf, sb, xb)

    def _read(self, x: np.ndarray, mask: np.ndarray, d: str, y: np.ndarray) -> None:
        """Adds one direction's part of the logits to ``y`` (time, batch, labels); for inference, in place.

        The backward direction runs from the end with its state held at 0 on the padding."""
        H, (T, B) = self.hidden, x.shape
        half = np.concatenate([np.full(2 * H, 0.5, np.float32), np.ones(H, np.float32)])
        gates, rec = self.w[f"in_{d}"] * half, self.w[f"rec_{d}"] * half
        rec_zr, rec_c = np.ascontiguousarray(rec[:, : 2 * H]), np.ascontiguousarray(rec[:, 2 * H :])
        gates_zr, gates_c = np.ascontiguousarray(gates[:, : 2 * H]), np.ascontiguousarray(gates[:, 2 * H :])
        out = self.w["out"][:H] if d == "f" else self.w["out"][H:]
        h, tmp, c = (np.zeros((B, H), dtype=np.float32) for _ in range(3))
        zr, acc = np.empty((B, 2 * H), dtype=np.float32), np.empty((B, 2 * H), dtype=np.float32)
        for t in range(T) if d == "f" else range(T - 1, -1, -1):
            np.take(gates_zr, x[t], axis=0, out=zr, mode="clip")
            np.matmul(h, rec_zr, out=acc)
            zr += acc
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            np.multiply(zr[:, H:], h, out=tmp)
            np.take(gates_c, x[t], axis=0, out=c, mode="clip")
            c += tmp @ rec_c
            np.tanh(c, out=c)
            c -= h
            c *= zr[:, :H]
            h += c
            if d == "b":
                h *= mask[t][:, None]
            y[t] += h @ out

    def pooled(self, texts: list[str], batch: int = 1024) -> np.ndarray:
        """Mean log-probability over the positions of each text, (texts, labels); zeros for an empty text."""
        out = np.zeros((len(texts), self.labels), dtype=np.float32)
        seqs = encode(texts)
        order = sorted(range(len(seqs)), key=lambda i: len(seqs[i]))
        at = 0
        while at < len(order):
            # a batch holds about the same number of positions whatever the texts' length
            longest = len(seqs[order[min(at + batch, len(order)) - 1]])
            take = order[at : at + max(1, min(batch, 400_000 // max(1, longest)))]
            at += len(take)
            x, lengths = padded([seqs[i] for i in take])
            mask = (np.arange(x.shape[0])[:, None] < lengths).astype(np.float32)
            y = np.broadcast_to(self.w["bias"], (*x.shape, self.labels)).copy()
            self._read(x, mask, "f", y)
            self._read(x, mask, "b", y)
            y -= y.max(axis=2, keepdims=True)
            y -= np.log(np.exp(y).sum(axis=2, keepdims=True))
            out[take] = np.einsum("tbk,tb->bk", y, mask) / np.maximum(lengths, 1)[:, None]
        return out

    # ---- training
    def _back(self, x, d: str, states, saved, dstates, grads) -> None:
        H, (T, B) = self.hidden, x.shape
        rec = self.w[f"rec_{d}"]
        dh = np.zeros((B, H), dtype=np.float32)
        din = np.empty((T, B, 3 * H), dtype=np.float32)
        for t in range(T - 1, -1, -1):
            h, z, r, rh, c = saved[t]
            dh = dh + dstates[t]
            dc = dh * z * (1 - c * c)
            dz = dh * (c - h) * z * (1 - z)
            drh = dc @ rec[:, 2 * H :].T
            dr = drh * h * r * (1 - r)
            din[t, :, :H], din[t, :, H : 2 * H], din[t, :, 2 * H :] = dz, dr, dc
            grads[f"rec_{d}"][:, :H] += h.T @ dz
            grads[f"rec_{d}"][:, H : 2 * H] += h.T @ dr
            grads[f"rec_{d}"][:, 2 * H :] += rh.T @ dc
            dh = dh * (1 - z) + drh * r + dz @ rec[:, :H].T + dr @ rec[:, H : 2 * H].T
        np.add.at(grads[f"in_{d}"], x.reshape(-1), din.reshape(T * B, 3 * H))

    def loss_and_grads(self, x: np.ndarray, lengths: np.ndarray, target: np.ndarray):
        """Mean cross-entropy over all positions, and its gradients."""
        H = self.hidden
        y, (f, b, sf, sb, xb) = self._logits(x, lengths, keep=True)
        y = y - y.max(axis=2, keepdims=True)
        p = np.exp(y)
        p /= p.sum(axis=2, keepdims=True)
        mask = (np.arange(x.shape[0])[:, None] < lengths).astype(np.float32)
        n = max(1.0, float(mask.sum()))
        loss = float(-(np.log(np.maximum(p[:, np.arange(len(target)), target], 1e-9)) * mask).sum() / n)
        dy = p
        dy[:, np.arange(len(target)), target] -= 1
        dy *= (mask / n)[:, :, None]
        grads = {k: np.zeros_like(v) for k, v in self.w.items()}
        dyb = _reverse3(dy, lengths)
        grads["out"][:H] = np.einsum("tbh,tbk->hk", f, dy)
        grads["out"][H:] = np.einsum("tbh,tbk->hk", b, dyb)
        grads["bias"] = dy.sum(axis=(0, 1))
        self._back(x, "f", f, sf, dy @ self.w["out"][:H].T, grads)
        self._back(xb, "b", b, sb, dyb @ self.w["out"][H:].T, grads)
        return loss, grads

    def fit(self, texts: list[str], labels: np.ndarray, steps: int = 500, batch: int = 96, window: int = 48, rate: float = 0.02, seed: int = 0) -> list[float]:
        """Adam on windows of ``window`` bytes drawn from the texts; languages are drawn alike often."""
        rng = np.random.default_rng(seed)
        seqs = encode(texts)
        by = [np.flatnonzero((labels == k) & np.array([len(s) > 0 for s in seqs])) for k in range(self.labels)]
        have = [k for k in range(self.labels) if len(by[k])]
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.w.items()}
        losses = []
        if not have:
            return losses
        for step in range(1, steps + 1):
            ks = rng.choice(have, size=batch)
            picked = []
            for k in ks:
                s = seqs[by[k][rng.integers(len(by[k]))]]
                a = int(rng.integers(max(1, len(s) - window + 1)))
                picked.append(s[a : a + window])
            x, lengths = padded(picked)
            loss, grads = self.loss_and_grads(x, lengths, ks)
            losses.append(loss)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            lr = rate * min(1.0, 2.0 * (1 - step / (steps + 1)))
            for k, g in grads.items():
                g = g * min(1.0, 1.0 / max(norm, 1e-6))
                m[k] = 0.9 * m[k] + 0.1 * g
                v2[k] = 0.99 * v2[k] + 0.01 * g * g
                self.w[k] -= lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-8)
        return losses


def _reverse3(y: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    t = np.arange(y.shape[0])[:, None]
    return np.take_along_axis(y, np.where(t < lengths, lengths - 1 - t, t)[:, :, None], axis=0)
