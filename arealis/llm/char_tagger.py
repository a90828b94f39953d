"""Character tagger: a bidirectional LSTM with transitions of a conditional random field, in numpy."""

from __future__ import annotations

import numpy as np

CHARACTERS = 97  # 95 printable ASCII characters, everything else, and the place after the end of a text
OTHER, PAD = 95, 96


def encode(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    return np.where((codes >= 32) & (codes < 127), codes - 32, OTHER).astype(np.int16)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def start_parameters(tags: int, width: int, hidden: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def normal(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    out = {"embed": (rng.standard_normal((CHARACTERS, width)) * 0.5).astype(np.float32)}
    for side in ("fwd", "bwd"):
        out[f"{side}_in"], out[f"{side}_state"] = normal(width, 4 * hidden), normal(hidden, 4 * hidden)
        out[f"{side}_bias"] = np.zeros(4 * hidden, np.float32)
        out[f"{side}_bias"][hidden : 2 * hidden] = 1.0  # remember at first
    out["out"], out["out_bias"] = normal(2 * hidden, tags), np.zeros(tags, np.float32)
    out["moves"] = np.zeros((tags, tags), np.float32)
    return out


def _lstm(x: np.ndarray, w_in: np.ndarray, w_state: np.ndarray, bias: np.ndarray, keep: bool) -> tuple[np.ndarray, list | None]:
    """States over time for inputs (time, batch, width); with what the backward pass needs if ``keep``."""
    steps, batch, _ = x.shape
    size = w_state.shape[0]
    ready = x @ w_in + bias
    h = np.zeros((batch, size), np.float32)
    c = np.zeros((batch, size), np.float32)
    states = np.empty((steps, batch, size), np.float32)
    kept = [] if keep else None
    for t in range(steps):
        z = ready[t] + h @ w_state
        gates = _sigmoid(z[:, : 3 * size])
        i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
        g = np.tanh(z[:, 3 * size :])
        before, c = c, f * c + i * g
        tc = np.tanh(c)
        if keep:
            kept.append((h, before, i, f, o, g, tc))
        h = o * tc
        states[t] = h
    return states, kept


def _lstm_back(slope: np.ndarray, x: np.ndarray, kept: list, w_in: np.ndarray, w_state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    steps, batch, size = slope.shape
    dz = np.empty((steps, batch, 4 * size), np.float32)
    d_state = np.zeros_like(w_state)
    dh, dc = np.zeros((batch, size), np.float32), np.zeros((batch, size), np.float32)
    for t in range(steps - 1, -1, -1):
        h, before, i, f, o, g, tc = kept[t]
        dh = dh + slope[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz[t] = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
        d_state += h.T @ dz[t]
        dh, dc = dz[t] @ w_state.T, dc * f
    flat = dz.reshape(-1, 4 * size)
    return dz @ w_in.T, x.reshape(-1, x.shape[2]).T @ flat, d_state, flat.sum(0)


def emissions(p: dict[str, np.ndarray], codes: np.ndarray, keep: bool = False):
    """Scores of the tags (time, batch, tags) for windows of character codes (batch, time)."""
    x = p["embed"][codes.T]
    ahead, kept_a = _lstm(x, p["fwd_in"], p["fwd_state"], p["fwd_bias"], keep)
    back, kept_b = _lstm(x[::-1], p["bwd_in"], p["bwd_state"], p["bwd_bias"], keep)
    both = np.concatenate([ahead, back[::-1]], 2)
    scores = both @ p["out"] + p["out_bias"]
    return (scores, (x, both, kept_a, kept_b)) if keep else scores


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def field_slopes(scores: np.ndarray, moves: np.ndarray, gold: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood of the gold tags (time, batch) and its slopes in the scores and the moves."""
    steps, batch, tags = scores.shape
    ahead, back = np.empty_like(scores), np.zeros_like(scores)
    ahead[0] = scores[0]
    for t in range(1, steps):
        ahead[t] = scores[t] + _log_sum(ahead[t - 1][:, :, None] + moves, 1)
    for t in range(steps - 2, -1, -1):
        back[t] = _log_sum(moves + (scores[t + 1] + back[t + 1])[:, None, :], 2)
    total = _log_sum(ahead[-1], 1)
    slope = np.exp(ahead + back - total[None, :, None])
    d_moves = np.zeros_like(moves)
    for t in range(1, steps):
        d_moves += np.exp(ahead[t - 1][:, :, None] + moves + (scores[t] + back[t])[:, None, :] - total[:, None, None]).sum(0)
    np.add.at(d_moves, (gold[:-1].ravel(), gold[1:].ravel()), -1)
    rows = np.arange(batch)
    loss = total.copy()
    for t in range(steps):
        loss -= scores[t, rows, gold[t]]
        slope[t, rows, gold[t]] -= 1
    loss -= moves[gold[:-1], gold[1:]].sum(0)
    return float(loss.mean()), (slope / batch).astype(np.float32), (d_moves / batch).astype(np.float32)


def slopes(p: dict[str, np.ndarray], codes: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    scores, (x, both, kept_a, kept_b) = emissions(p, codes, True)
    loss, d, d_moves = field_slopes(scores, p["moves"], gold.T)
    size = p["fwd_state"].shape[0]
    flat = d.reshape(-1, d.shape[2])
    out = {"moves": d_moves, "out": both.reshape(-1, 2 * size).T @ flat, "out_bias": flat.sum(0)}
    d_both = d @ p["out"].T
    dx, out["fwd_in"], out["fwd_state"], out["fwd_bias"] = _lstm_back(d_both[:, :, :size], x, kept_a, p["fwd_in"], p["fwd_state"])
    back, out["bwd_in"], out["bwd_state"], out["bwd_bias"] = _lstm_back(d_both[::-1, :, size:], x[::-1], kept_b, p["bwd_in"], p["bwd_state"])
    dx = dx + back[::-1]
    out["embed"] = np.zeros_like(p["embed"])
    np.add.at(out["embed"], codes.T, dx)
    return loss, out


def train(codes: np.ndarray, gold: np.ndarray, tags: int, width: int = 12, hidden: int = 16, steps: int = 250, batch: int = 48, rate: float = 0.01, seed: int = 4) -> dict[str, np.ndarray]:
    """Fit windows (rows of codes) to their tags by Adam with clipped slopes."""
    p = start_parameters(tags, width, hidden, seed)
    rng = np.random.default_rng(seed + 1)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, steps + 1 if len(codes) else 1):
        pick = rng.integers(0, len(codes), batch)
        _, d = slopes(p, codes[pick], gold[pick])
        norm = np.sqrt(sum(float((v * v).sum()) for v in d.values()))
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, v in d.items():
            v = v * min(1.0, 5.0 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * v
            second[k] = 0.99 * second[k] + 0.01 * v * v
            p[k] = (p[k] - pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return p


def decode(scores: list[np.ndarray], moves: np.ndarray) -> list[np.ndarray]:
    """Best tags of each run of scores (length, tags); runs of any length go step by step together."""
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    lengths = np.array([len(scores[i]) for i in order])
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(scores)
    if not len(lengths) or not lengths[0]:
        return out
    tags = moves.shape[0]
    steps = int(lengths[0])
    running = np.searchsorted(-lengths, -np.arange(1, steps + 1), "right")
    best = np.zeros((len(order), tags))
    came = [np.zeros((0, tags), np.int8)]
    for t in range(steps):
        n = running[t]
        now = np.stack([scores[i][t] for i in order[:n]])
        if t == 0:
            best[:n] = now
            continue
        ways = best[:n, :, None] + moves
        came.append(ways.argmax(1).astype(np.int8))
        best[:n] = ways.max(1) + now
    for rank, i in enumerate(order):
        tags_i = np.zeros(lengths[rank], np.int64)
        if lengths[rank]:
            tags_i[-1] = best[rank].argmax()
            for t in range(lengths[rank] - 1, 0, -1):
                tags_i[t - 1] = came[t][rank, tags_i[t]]
        out[i] = tags_i
    return out
