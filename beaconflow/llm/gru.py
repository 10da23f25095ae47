"""A bidirectional gated recurrent network with attention pooling, in numpy.

A window of words goes through one network from each side; every word's two
states are weighed by an attention layer and their weighted sum gives a logit.
Inputs are projected once per distinct word, so a step costs one small product.
"""

from __future__ import annotations

import numpy as np

#: Units of each direction, and of the attention layer.
UNITS = 8


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """Parameters, forward and backward pass."""

    def __init__(self, inputs: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        draw = lambda a, b: (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        self.p: dict[str, np.ndarray] = {}
        for side in "fb":
            self.p[f"{side}_in"] = draw(inputs, 3 * UNITS)
            self.p[f"{side}_bias"] = np.zeros(3 * UNITS, np.float32)
            self.p[f"{side}_state"] = draw(UNITS, 3 * UNITS)
        self.p["attend"] = draw(2 * UNITS, UNITS)
        self.p["attend_bias"] = np.zeros(UNITS, np.float32)
        self.p["attend_out"] = draw(UNITS, 1)[:, 0]
        self.p["out"] = draw(2 * UNITS, 1)[:, 0]
        self.p["out_bias"] = np.zeros(1, np.float32)

    def project(self, features: np.ndarray) -> np.ndarray:
        """The input of the gates of both directions for each row of ``features``."""
        p = self.p
        return np.hstack([features @ p["f_in"] + p["f_bias"], features @ p["b_in"] + p["b_bias"]])

    def _states(self, gates: np.ndarray, codes: np.ndarray, mask: np.ndarray | None, side: str, kept: list | None) -> np.ndarray:
        """States (steps, windows, units) of one direction; ``kept`` collects what the backward pass needs."""
        steps, u = codes.shape[1], UNITS
        own = np.ascontiguousarray(gates[:, : 3 * u] if side == "f" else gates[:, 3 * u :])
        state = self.p[f"{side}_state"]
        h = np.zeros((len(codes), u), np.float32)
        out = np.empty((steps, len(codes), u), np.float32)
        for t in range(steps) if side == "f" else reversed(range(steps)):
            x, s = own[codes[:, t]], h @ state
            zr = _sigmoid(x[:, : 2 * u] + s[:, : 2 * u])
            z, r = zr[:, :u], zr[:, u:]
            c = np.tanh(x[:, 2 * u :] + r * s[:, 2 * u :])
            step = z * (c - h)
            if mask is not None:
                step *= mask[:, t, None]
            if kept is not None:
                kept.append((t, h, z, r, c, s[:, 2 * u :]))
            h = h + step
            out[t] = h
        return out

    def logits(self, gates: np.ndarray, codes: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
        """One logit for each window; ``codes`` (windows, steps) are rows of ``gates``, ``mask`` is 0 at padding."""
        return self._forward(gates, codes, mask, None)[0]

    def _forward(self, gates, codes, mask, kept):
        p = self.p
        own = ([], []) if kept is not None else (None, None)
        both = np.concatenate([self._states(gates, codes, mask, s, k) for s, k in zip("fb", own, strict=True)], axis=2)
        seen = np.tanh(both @ p["attend"] + p["attend_bias"])
        weight = seen @ p["attend_out"]
        if mask is not None:
            weight = np.where(mask.T > 0, weight, np.float32(-1e9))
        weight = np.exp(weight - weight.max(axis=0))
        if mask is not None:
            weight *= mask.T
        weight /= np.maximum(weight.sum(axis=0), np.float32(1e-9))
        pooled = np.einsum("tn,tnu->nu", weight, both)
        if kept is not None:
            kept.append((own, both, seen, weight, pooled))
        return pooled @ p["out"] + p["out_bias"][0], pooled

    def gradients(self, features: np.ndarray, codes: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean logistic loss of the windows, and its gradient by every parameter."""
        p, u, n = self.p, UNITS, len(codes)
        gates, kept = self.project(features), []
        logit, _ = self._forward(gates, codes, mask, kept)
        own, both, seen, weight, pooled = kept[0]
        loss = float(np.mean(np.logaddexp(0, logit) - labels * logit))
        d_logit = ((_sigmoid(logit) - labels) / n).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["out"], g["out_bias"][0] = pooled.T @ d_logit, d_logit.sum()
        d_pooled = d_logit[:, None] * p["out"]
        d_both = weight[:, :, None] * d_pooled
        d_weight = np.einsum("tnu,nu->tn", both, d_pooled)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["attend_out"] = np.einsum("tn,tna->a", d_score, seen)
        d_seen = d_score[:, :, None] * p["attend_out"] * (1 - seen * seen)
        g["attend"] = np.einsum("tnu,tna->ua", both, d_seen)
        g["attend_bias"] = d_seen.sum(axis=(0, 1))
        d_both = d_both + d_seen @ p["attend"].T
        for i, side in enumerate("fb"):
            d_gates = np.zeros((len(features), 3 * u), np.float32)
            state, d_h = p[f"{side}_state"], np.zeros((n, u), np.float32)
            for t, h, z, r, c, s in reversed(own[i]):
                d_h = d_h + d_both[t, :, i * u : (i + 1) * u]
                d_step = d_h * mask[:, t, None]
                d_c = d_step * z * (1 - c * c)
                d_z = d_step * (c - h) * z * (1 - z)
                d_r = d_c * s * r * (1 - r)
                d_x = np.hstack([d_z, d_r, d_c])
                d_s = np.hstack([d_z, d_r, d_c * r])
                np.add.at(d_gates, codes[:, t], d_x)
                g[f"{side}_state"] += h.T @ d_s
                d_h = d_h - d_step * z + d_s @ state.T
            g[f"{side}_in"] = features.T @ d_gates
            g[f"{side}_bias"] = d_gates.sum(axis=0)
        return loss, g


class Adam:
    """Steps of bounded size along smoothed gradients."""

    def __init__(self, parameters: dict[str, np.ndarray], rate: float = 0.02, decay: float = 1e-4):
        self.p, self.rate, self.decay, self.n = parameters, rate, decay, 0
        self.mean = {k: np.zeros_like(v) for k, v in parameters.items()}
        self.square = {k: np.zeros_like(v) for k, v in parameters.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.n += 1
        for k, g in gradients.items():
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.01 * (g * g - self.square[k])
            size = np.sqrt(self.square[k] / (1 - 0.99**self.n)) + 1e-8
            self.p[k] -= (self.rate * (self.mean[k] / (1 - 0.9**self.n) / size + self.decay * self.p[k])).astype(np.float32)
