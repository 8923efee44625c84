"""A bidirectional gated recurrent classifier with attention pooling, in numpy.

A word enters as the mean embedding of its hashed character trigrams beside a
hashed embedding of the whole word. Both directions run side by side in one
state, kept apart by a block-diagonal recurrent matrix.
"""

from __future__ import annotations

import numpy as np
import xxhash

TRIGRAMS, WORDS = 4096, 32768
CHAR_DIM, WORD_DIM, HIDDEN, ATTEND = 12, 8, 8, 8
WIDTH, STRIDE = 64, 48
BATCH = 512
#: In training: share of the words left out of a window, and pull of the embeddings to their beginning, per unit of the rate.
LEFT_OUT, PULL = 0.1, 1.0
CACHED_WORDS = 1 << 17

Params = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _tanh(x: np.ndarray) -> np.ndarray:
    return 2 / (1 + np.exp(np.clip(-2 * x, -30, 30))) - 1


def initial(seed: int = 7) -> Params:
    rng = np.random.default_rng(seed)
    size, both = CHAR_DIM + WORD_DIM, 2 * HIDDEN

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {
        "chars": normal(TRIGRAMS, CHAR_DIM, scale=0.15), "words": normal(WORDS, WORD_DIM, scale=0.02),
        "ahead": normal(size, 3 * HIDDEN, scale=size**-0.5), "back": normal(size, 3 * HIDDEN, scale=size**-0.5),
        "state": normal(both, 3 * both, scale=HIDDEN**-0.5) * _blocks(),
        "bias": np.zeros(3 * both, np.float32), "attend": normal(both, ATTEND, scale=both**-0.5),
        "focus": normal(ATTEND, scale=ATTEND**-0.5), "out": normal(both, scale=both**-0.5),
        "shift": np.zeros(1, np.float32),
    }


def _blocks() -> np.ndarray:
    """1 where the recurrent matrix stays inside one direction."""
    side = np.arange(2 * HIDDEN) // HIDDEN
    return np.tile((side[:, None] == side[None, :]).astype(np.float32), 3)


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, trigram buckets of all words in a row, and where each word's start."""
    buckets = np.fromiter((xxhash.xxh32_intdigest(w) % WORDS for w in words), np.int64, len(words))
    text = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), np.uint8).astype(np.uint32)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 2)
    starts = ends - np.diff(ends, prepend=0)
    at = np.ones(len(text), bool)
    at[ends - 1] = at[ends - 2] = False
    at = np.flatnonzero(at)
    mixed = (text[at] * np.uint32(0x9E3779B1) + text[at + 1] * np.uint32(0x85EBCA77)) ^ (
        text[at + 2] * np.uint32(0xC2B2AE3D)
    )
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x27D4EB2F)
    return buckets, (mixed >> np.uint32(20)).astype(np.int64), np.searchsorted(at, starts)


def embed(p: Params, buckets: np.ndarray, trigrams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    counts = np.diff(starts, append=len(trigrams))[:, None]
    chars = np.add.reduceat(p["chars"][trigrams], starts, axis=0) / counts
    return np.concatenate([chars, p["words"][buckets]], axis=1).astype(np.float32)


def windows(length: int) -> np.ndarray:
    """Starts of the overlapping windows; the last one ends with the text."""
    if length <= WIDTH:
        return np.zeros(min(length, 1), np.int64)
    return np.append(np.arange(0, length - WIDTH, STRIDE), length - WIDTH)


def _inputs(ahead: np.ndarray, back: np.ndarray, ids: np.ndarray, t: int) -> np.ndarray:
    """Gate inputs of step ``t``: forward at position t, backward at the mirrored one."""
    a = ahead[ids[:, t]].reshape(-1, 3, HIDDEN)
    b = back[ids[:, ids.shape[1] - 1 - t]].reshape(-1, 3, HIDDEN)
    return np.concatenate([a, b], axis=2).reshape(len(ids), 6 * HIDDEN)


def forward(p: Params, table: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Logits of windows of rows of ``table``; ``keep`` collects what backward needs."""
    return recur(p, table @ p["ahead"], table @ p["back"], ids, mask, keep)


def recur(
    p: Params, ahead: np.ndarray, back: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: list | None = None
) -> np.ndarray:
    count, steps = ids.shape
    both = 2 * HIDDEN
    h = np.zeros((count, both), np.float32)
    states = np.empty((count, steps, both), np.float32)
    full = bool(mask.all())
    for t in range(steps):
        given = _inputs(ahead, back, ids, t) + p["bias"]
        own = h @ p["state"]
        gates = _sigmoid(given[:, : 2 * both] + own[:, : 2 * both])
        z, r = gates[:, :both], gates[:, both:]
        c = _tanh(given[:, 2 * both :] + r * own[:, 2 * both :])
        step = z * (c - h)
        if not full:
            m = np.repeat(np.stack([mask[:, t], mask[:, steps - 1 - t]], axis=1), HIDDEN, axis=1)
            step = step * m
        if keep is not None:
            keep.append((h, z, r, c, own[:, 2 * both :], None if full else m))
        h = h + step
        states[:, t, :HIDDEN] = h[:, :HIDDEN]
        states[:, steps - 1 - t, HIDDEN:] = h[:, HIDDEN:]
    u = _tanh(states @ p["attend"])
    e = np.where(mask, u @ p["focus"], np.float32(-1e9))
    e = np.exp(e - e.max(axis=1, keepdims=True))
    share = e / e.sum(axis=1, keepdims=True)
    pooled = np.einsum("nt,nth->nh", share, states)
    if keep is not None:
        keep.append((states, u, share, pooled))
    return pooled @ p["out"] + p["shift"][0]


def backward(
    p: Params, table: np.ndarray, ids: np.ndarray, keep: list, slope: np.ndarray
) -> tuple[Params, np.ndarray]:
    """Gradients of the parameters and of ``table``, given those of the logits."""
    states, u, share, pooled = keep.pop()
    steps, both = ids.shape[1], 2 * HIDDEN
    grad = {k: np.zeros_like(v) for k, v in p.items() if k not in ("chars", "words")}
    grad["out"], grad["shift"][0] = pooled.T @ slope, slope.sum()
    dpool = slope[:, None] * p["out"]
    dshare = np.einsum("nh,nth->nt", dpool, states)
    de = share * (dshare - (share * dshare).sum(axis=1, keepdims=True))
    du = de[:, :, None] * p["focus"] * (1 - u * u)
    grad["focus"] = np.einsum("nt,nta->a", de, u)
    grad["attend"] = np.einsum("nth,nta->ha", states, du)
    dstates = share[:, :, None] * dpool[:, None, :] + du @ p["attend"].T
    dtable = np.zeros_like(table)
    dh = np.zeros((len(ids), both), np.float32)
    for t in range(steps - 1, -1, -1):
        h, z, r, c, own_c, m = keep[t]
        dh[:, :HIDDEN] += dstates[:, t, :HIDDEN]
        dh[:, HIDDEN:] += dstates[:, steps - 1 - t, HIDDEN:]
        dstep = dh if m is None else dh * m
        dz = dstep * (c - h) * z * (1 - z)
        dc = dstep * z * (1 - c * c)
        dr = dc * own_c * r * (1 - r)
        given = np.concatenate([dz, dr, dc], axis=1)
        own = np.concatenate([dz, dr, dc * r], axis=1)
        grad["bias"] += given.sum(axis=0)
        grad["state"] += h.T @ own
        dh = dh - dstep * z + own @ p["state"].T
        sides = given.reshape(-1, 3, 2, HIDDEN)
        for side, name, at in ((0, "ahead", t), (1, "back", steps - 1 - t)):
            g, rows = sides[:, :, side].reshape(-1, 3 * HIDDEN), ids[:, at]
            grad[name] += table[rows].T @ g
            np.add.at(dtable, rows, g @ p[name].T)
    grad["state"] *= _blocks()
    return grad, dtable


class Scorer:
    """Window logits of word lists under one set of parameters."""

    def __init__(self, p: Params) -> None:
        self.p = p
        self._reset()

    def _reset(self) -> None:
        self.index: dict[bytes, int] = {}
        self.ahead = np.zeros((1, 3 * HIDDEN), np.float32)
        self.back = np.zeros((1, 3 * HIDDEN), np.float32)

    def _learn(self, words: list[bytes]) -> None:
        table = embed(self.p, *features(words))
        first = len(self.ahead)
        self.index.update(zip(words, range(first, first + len(words)), strict=True))
        self.ahead = np.concatenate([self.ahead, table @ self.p["ahead"]])
        self.back = np.concatenate([self.back, table @ self.p["back"]])

    def window_logits(self, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Logits of all windows of all texts, and the text each belongs to."""
        if len(self.index) > CACHED_WORDS:
            self._reset()
        new = list({w for words in docs for w in words}.difference(self.index))
        if new:
            self._learn(sorted(new))
        rows, masks, owners = [], [], []
        for n, words in enumerate(docs):
            ids = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
            starts = windows(len(ids))
            if not len(starts):
                continue
            if len(ids) < WIDTH:
                padded = np.zeros((1, WIDTH), np.int64)
                padded[0, : len(ids)] = ids
                rows.append(padded)
            else:
                rows.append(ids[starts[:, None] + np.arange(WIDTH)])
            masks.append(np.arange(WIDTH)[None, :] < min(len(ids), WIDTH) if len(starts) == 1 else np.ones((len(starts), WIDTH), bool))
            owners.append(np.full(len(starts), n))
        if not rows:
            return np.empty(0, np.float32), np.empty(0, np.int64)
        ids, mask, owner = np.concatenate(rows), np.concatenate(masks), np.concatenate(owners)
        out = np.empty(len(ids), np.float32)
        for at in range(0, len(ids), BATCH):
            part = slice(at, at + BATCH)
            out[part] = recur(self.p, self.ahead, self.back, ids[part], mask[part])
        return out, owner


class Trainer:
    """Adam over windows. Words are left out at random, and embeddings are pulled to where
    they began, so that the network learns what many texts share rather than each text by heart."""

    def __init__(self, seed: int = 7, rate: float = 0.01, told: np.ndarray | None = None) -> None:
        """``told`` is what is known of each word bucket beforehand; it begins as the first number of its embedding."""
        self.p, self.rate, self.step = initial(seed), rate, 0
        if told is not None:
            self.p["words"][:, 0] += told.astype(np.float32)
        self.begun = {k: self.p[k].copy() for k in ("words", "chars")}
        self.first = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.second = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.rng = np.random.default_rng(seed)

    def update(self, words: list[list[bytes]], targets: np.ndarray, weights: np.ndarray) -> None:
        distinct = sorted({w for ws in words for w in ws})
        index = {w: n + 1 for n, w in enumerate(distinct)}
        buckets, trigrams, starts = features(distinct)
        table = np.concatenate([np.zeros((1, CHAR_DIM + WORD_DIM), np.float32), embed(self.p, buckets, trigrams, starts)])
        ids = np.zeros((len(words), WIDTH), np.int64)
        mask = np.zeros((len(words), WIDTH), bool)
        for n, ws in enumerate(words):
            ids[n, : len(ws)] = [index[w] for w in ws]
            mask[n, : len(ws)] = True
        left = mask & (self.rng.random(mask.shape) >= LEFT_OUT)
        mask = np.where(left.any(axis=1, keepdims=True), left, mask)
        keep: list = []
        logits = forward(self.p, table, ids, mask, keep)
        slope = ((_sigmoid(logits) - targets) * weights / weights.sum()).astype(np.float32)
        grad, dtable = backward(self.p, table, ids, keep, slope)
        grad["words"], grad["chars"] = np.zeros_like(self.p["words"]), np.zeros_like(self.p["chars"])
        np.add.at(grad["words"], buckets, dtable[1:, CHAR_DIM:])
        counts = np.diff(starts, append=len(trigrams))
        np.add.at(grad["chars"], trigrams, np.repeat(dtable[1:, :CHAR_DIM] / counts[:, None], counts, axis=0))
        self.step += 1
        for k, g in grad.items():
            self.first[k] += 0.1 * (g - self.first[k])
            self.second[k] += 0.001 * (g * g - self.second[k])
            rate = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
            self.p[k] -= (rate * self.first[k] / (np.sqrt(self.second[k]) + 1e-8)).astype(np.float32)
        for k, begun in self.begun.items():
            self.p[k] -= np.float32(self.rate * PULL) * (self.p[k] - begun)
