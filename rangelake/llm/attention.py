"""A small causal self-attention language model in numpy: one layer, trained by Adam, with a two-level softmax.

Tokens are slots: 0 is the begin and end of a text, the others stand in order of frequency. The first HEAD slots have rows
of the input tables and classes of WIDE of their own; the tail, as many classes as slots in a class, has a row for each
class. A slot's probability is that of its class times that of the slot inside its class; a class of the tail is reached
through the tail's own class, so a frequent token takes about 2 * WIDE exponentials whatever the vocabulary.

Texts are cut into blocks of BLOCK tokens. A block and the one before it are a window: the block's tokens are scored, and
attention sees, under a mask, what stands before them in the window. So windows overlap by half, and each token is scored
once, BLOCK to WINDOW - 1 tokens behind the window's begin inside a long text. A token's input is the sum of what the last
LAST slots add to it (a short causal convolution, by table). So one query serves EACH tokens in a row: it sees the first
of them and all before it in the window, and the convolution brings in the tokens between.
"""

from __future__ import annotations

import numpy as np

from rangelake.llm.exponentials import exponentiate

#: Slots in a class of the head, classes of the head, and the slots that have their own class there.
WIDE = 32
HEAD = WIDE * WIDE
#: Width of the model, of queries and keys, of the inner layer.
D, KEY, INNER = 32, 8, 32
#: Tokens of a block and of a window, tokens that a query serves, and slots that an input adds up.
BLOCK, WINDOW, EACH, LAST = 32, 64, 4, 3
#: Blocks that training takes in a row, rows in a step, and of how many steps one also moves what stands before the last
#: states (the others, which cost half as much, move the two levels of the softmax).
RUN, ROWS, DEEP = 4, 64, 4
#: What a score gets that is set to 0 later: exponentials that are no normal numbers take several times as long.
MASKED = np.float32(-50)
_EYE = np.eye(WIDE, dtype=np.float32)


def spread(slots: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts that stand one behind the other: their tokens in whole blocks (the rest of a last block is 0), where each
    token went, and which blocks begin a text."""
    blocks = -(-lengths // BLOCK)
    begins = (np.cumsum(blocks) - blocks) * BLOCK
    place = np.repeat(begins - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    y = np.zeros(int(blocks.sum()) * BLOCK, dtype=np.int32)
    y[place] = slots
    first = np.zeros(len(y) // BLOCK, dtype=bool)
    first[(begins // BLOCK)[lengths > 0]] = True
    return y, place, first


def before(y: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The LAST tokens before each place of blocks ``y``; 0 before the blocks that are first."""
    x = np.zeros((LAST, len(y)), dtype=np.int32)
    starts = np.flatnonzero(first) * BLOCK
    line = y
    for row in x:
        row[1:] = line[:-1]
        row[starts] = 0
        line = row
    return x


def product(a: np.ndarray, w: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """a @ w for many rows a and a small w, as one call: parts of 128 rows take a fifth longer."""
    return np.matmul(a, w, out=out)


def gram(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a.T @ b for many rows a and b."""
    return a.T @ b


def _sums(rows: np.ndarray, d: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    """The sum of the lines of ``d`` for each of n rows, a product for each WIDE rows. ``rows`` in the given order ascend;
    the lines of ``d`` stand in that order."""
    n = -(-n // WIDE) * WIDE
    rows = rows.take(order)
    which = _EYE.take(rows & (WIDE - 1), axis=0)
    bounds = np.searchsorted(rows, np.arange(0, n + 1, WIDE)).tolist()
    out = np.zeros((n, d.shape[1]), dtype=d.dtype)
    for k, (a, z) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if a < z:
            np.matmul(which[a:z].T, d[a:z], out=out[k * WIDE : (k + 1) * WIDE])
    return out


def _windows(z: np.ndarray, n: int) -> np.ndarray:
    """Each block of z behind the one before it; a view, whose windows overlap."""
    row, item = z.strides
    return np.lib.stride_tricks.as_strided(z, (n, WINDOW, z.shape[1]), (BLOCK * row, row, item), writeable=False)


def _softmax(z: np.ndarray, chosen: np.ndarray, back: bool) -> np.ndarray:
    """Log of the softmax of z's rows at the chosen columns. On the way back, z becomes the
    softmax less 1 there; else it is used up."""
    at = np.arange(0, z.size, z.shape[1]) + chosen
    flat = z.ravel()
    own = flat.take(at)
    exponentiate(z)
    total = z @ np.ones(z.shape[1], z.dtype)
    if len(total) and not total.max() < np.inf:
        raise FloatingPointError("the network's scores overflow")
    if back:
        z *= np.reciprocal(total)[:, None]
        flat[at] -= 1
    return own - np.log(total)


class Adam:
    """Steps on parameters ``p``, which are changed in place; of ``tail`` only the classes that a step touches (Adagrad)."""

    def __init__(self, p: dict[str, np.ndarray]) -> None:
        self.p, self.steps = p, dict.fromkeys(p, 0)
        self.mean, self.square = {k: np.zeros_like(w) for k, w in p.items() if k != "tail"}, {k: np.zeros_like(w) for k, w in p.items()}

    def step(self, g: dict[str, np.ndarray], touched: np.ndarray, rate: float) -> None:
        """``g`` may lack parameters, which then stay."""
        size = np.sqrt(sum(float(np.vdot(w, w)) for w in g.values()))
        scale = np.float32(min(1.0, 1.0 / (size + 1e-9)))
        for name, d in g.items():
            self.steps[name] += 1
            d *= scale
            if name == "tail":
                self.square[name][touched] += d * d
                self.p[name][touched] -= np.float32(rate * 3) * d / (np.sqrt(self.square[name][touched]) + np.float32(1e-8))
                continue
            mean, square, n = self.mean[name], self.square[name], self.steps[name]
            mean += (d - mean) * np.float32(0.1)
            d *= d
            square += (d - square) * np.float32(0.01)
            d = np.sqrt(square)
            d += np.float32(1e-8)
            np.divide(mean, d, out=d)
            d *= np.float32(rate * min(1.0, n / 10) * (1 - 0.99**n) ** 0.5 / (1 - 0.9**n))
            self.p[name] -= d


class Model:
    def __init__(self, slots: int = HEAD, seed: int = 0) -> None:
        rest = max(0, slots - HEAD)
        self.wide = max(1, int(np.ceil(np.sqrt(rest))))  # classes of the tail, and slots in one
        self.rows = HEAD + self.wide
        r = np.random.default_rng(seed)
        normal = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
        zero = lambda *shape: np.zeros(shape, np.float32)
        rows = -(-self.rows // WIDE) * WIDE
        self.p = {
            "embed": normal(rows, LAST, D, scale=0.3), "qkv": normal(D, 2 * KEY + D, scale=D**-0.5), "near": zero(WINDOW),
            "w1": normal(D, INNER, scale=D**-0.5), "w2": normal(INNER, D, scale=INNER**-0.5 / 2),
            "class": normal(D, WIDE + 1, scale=D**-0.5 / 2), "inner": normal(WIDE, D, WIDE, scale=D**-0.5 / 2),
            "tails": normal(D, self.wide, scale=D**-0.5 / 2), "tail": zero(self.wide, D, self.wide),
        }

    def row(self, slots: np.ndarray) -> np.ndarray:
        """Rows of the input tables."""
        return np.where(slots < HEAD, slots, HEAD + np.maximum(slots - HEAD, 0) // self.wide)

    def _bias(self) -> tuple[np.ndarray, np.ndarray]:
        """What is added to a query's scores, by distance, and 1 for what it sees, 0 for what stands behind it."""
        far, near = np.arange(0, BLOCK, EACH)[:, None] + BLOCK - np.arange(WINDOW), self.p["near"]
        return np.where(far >= 0, near[np.maximum(far, 0) % WINDOW], near.dtype.type(MASKED)), (far >= 0).astype(near.dtype)

    def _qkv(self) -> list[np.ndarray]:
        """What makes queries, keys and values of inputs."""
        return [np.ascontiguousarray(w) for w in np.split(self.p["qkv"], [KEY, 2 * KEY], axis=1)]

    def states(self, x: np.ndarray, first: np.ndarray, keep: bool = False) -> tuple:
        """Last states of blocks whose inputs are the rows x (LAST, tokens), and, with ``keep``, what the way back needs."""
        p, n = self.p, len(first)
        line = np.zeros(((n + 1) * BLOCK, D), p["embed"].dtype)  # nothing stands before the first block
        e = line[BLOCK:]
        more = np.empty_like(e)
        for k in range(LAST):  # without a mode ``out`` is buffered; no row is beyond the table
            p["embed"][:, k].take(x[k], axis=0, out=more if k else e, mode="clip")
            if k:
                e += more
        wq, wk, wv = self._qkv()
        q, k = product(e[::EACH], wq).reshape(n, -1, KEY), _windows(product(line, wk), n)
        a = q @ k.transpose(0, 2, 1)
        bias, seen = self._bias()
        a += bias
        exponentiate(a)
        a *= seen
        a[first, :, :BLOCK] = 0
        a *= np.reciprocal(a.reshape(-1, WINDOW) @ np.ones(WINDOW, a.dtype)).reshape(n, -1, 1)
        # values are linear in the inputs, so inputs are averaged, and what a query gets is made a value: a product for EACH tokens
        c = (a @ _windows(line, n)).reshape(-1, D)
        h = e.copy() if keep else e
        own = h.reshape(-1, EACH, D)
        own += product(c, wv)[:, None]
        r = product(h, p["w1"])
        r += np.abs(r)  # twice the rectified; np.maximum takes twice as long
        out = product(r, p["w2"] * p["w2"].dtype.type(0.5))
        out += h
        return out, (line, q, k, a, c, h, r) if keep else ()

    def _levels(self, h: np.ndarray, y: np.ndarray, back: bool, deep: bool = True) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray], np.ndarray]:
        """Log probabilities of slots y (in ascending order) after states h, and, on the way back, the gradients of their
        negative sum: by h (if ``deep``), by the parameters, and the classes of the tail that they touch."""
        p, m = self.p, len(y)
        ends = np.searchsorted(y, np.arange(0, HEAD + 1, WIDE)).tolist()
        top = ends[WIDE]  # from here on: the tail
        z = product(h, p["class"])
        out = _softmax(z, np.minimum(y // WIDE, WIDE), back)
        zi = np.empty((top, WIDE), h.dtype)
        for k, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
            if a < b:
                np.matmul(h[a:b], p["inner"][k], out=zi[a:b])
        out[:top] += _softmax(zi, y[:top] & (WIDE - 1), back)
        if back:
            g = {"class": gram(h, z), "inner": np.zeros_like(p["inner"]), "tails": np.zeros_like(p["tails"])}
            dh = product(z, p["class"].T) if deep else h
            for k, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                if a < b:
                    np.matmul(h[a:b].T, zi[a:b], out=g["inner"][k])
                    if deep:
                        dh[a:b] += zi[a:b] @ p["inner"][k].T
        touched = np.zeros(0, np.int64)
        if top < m:
            ht, (kind, place) = h[top:], np.divmod(y[top:] - HEAD, self.wide)
            zt = ht @ p["tails"]
            out[top:] += _softmax(zt, kind, back)
            if back:
                g["tails"] = gram(ht, zt)
                if deep:
                    dh[top:] += zt @ p["tails"].T
            touched, starts = np.unique(kind, return_index=True)
            parts = list(zip(touched.tolist(), starts.tolist(), [*starts.tolist()[1:], m - top], strict=True))
            zk = np.empty((m - top, self.wide), h.dtype)
            for k, a, b in parts:
                np.matmul(ht[a:b], p["tail"][k], out=zk[a:b])
            out[top:] += _softmax(zk, place, back)
            if back:
                g["tail"] = np.empty((len(touched), *p["tail"].shape[1:]), h.dtype)
                for i, (k, a, b) in enumerate(parts):
                    np.matmul(ht[a:b].T, zk[a:b], out=g["tail"][i])
                    if deep:
                        dh[top + a : top + b] += zk[a:b] @ p["tail"][k].T
        return (out, dh, g, touched) if back else (out, h, {}, touched)

    def log_probabilities(self, h: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural log of the probability of slots y after states h."""
        order = np.argsort(y.astype(np.uint16), kind="stable")
        out = np.empty(len(y), h.dtype)
        out[order] = self._levels(h.take(order, axis=0), y.take(order), False)[0]
        return out

    def gradients(self, x: np.ndarray, first: np.ndarray, at: np.ndarray, y: np.ndarray, deep: bool = True) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
        """Mean negative log probability of slots y at the places ``at`` of blocks x, its gradients, and the tail's touched
        classes. Not ``deep``: by the parameters behind the last states alone."""
        p, n, m = self.p, len(first), len(at)
        out, kept = self.states(x, first, deep)
        order = np.argsort(y.astype(np.uint16), kind="stable")
        own = at.take(order)
        logs, dh, g, touched = self._levels(out.take(own, axis=0), y.take(order), True, deep)
        for w in g.values():
            w *= out.dtype.type(1 / m)
        if not deep:
            return -float(logs.sum()) / m, g, touched
        line, q, k, a, c, h, r = kept
        dh *= h.dtype.type(1 / m)
        d2 = np.zeros_like(h)  # places that don't count have no gradient
        d2[own] = dh
        g["w2"] = gram(r, d2) * h.dtype.type(0.5)
        du = product(d2, p["w2"].T)
        du *= r > 0
        g["w1"] = gram(h, du)
        padded = np.zeros((len(h) + LAST - 1, D), h.dtype)
        d1 = product(du, p["w1"].T, padded[: len(h)])
        d1 += d2
        own = d1.reshape(-1, EACH, D)
        do = own[:, 0] + own[:, 1]
        for j in range(2, EACH):
            do += own[:, j]
        e, (wq, wk, wv) = line[BLOCK:], self._qkv()
        dc = product(do, wv.T)
        dots = np.einsum("ij,ij->i", dc, c).reshape(n, -1, 1)
        dc = dc.reshape(n, -1, D)
        ds = dc @ _windows(line, n).transpose(0, 2, 1)
        ds -= dots
        ds *= a
        dq, dk, de = (ds @ k).reshape(-1, KEY), ds.transpose(0, 2, 1) @ q, a.transpose(0, 2, 1) @ dc
        for d in (dk, de):  # a block stands in its own window and in the next one
            d[:-1, BLOCK:] += d[1:, :BLOCK]
        dk = dk[:, BLOCK:].reshape(-1, KEY)
        far = (np.arange(0, BLOCK, EACH)[:, None] + BLOCK - np.arange(WINDOW)).ravel()
        near = ds.sum(axis=0).ravel()
        g["near"] = np.bincount(far[far >= 0] % WINDOW, weights=near[far >= 0], minlength=WINDOW).astype(h.dtype)
        g["qkv"] = np.concatenate([gram(e[::EACH], dq), gram(e, dk), gram(c, do)], axis=1)
        d1[::EACH] += product(dq, wq.T)
        d1 += product(dk, wk.T)
        blocks = d1.reshape(n, BLOCK, D)
        blocks += de[:, BLOCK:]
        # the token at a place is the last one of the next input, and the one before it of the input behind that
        order = np.argsort(x[0].astype(np.uint16), kind="stable")
        row, item = padded.strides
        into = np.lib.stride_tricks.as_strided(padded, (n * BLOCK, LAST * D), (row, item), writeable=False)[order]
        place = np.empty(n * BLOCK, np.int64)
        place[order] = np.arange(n * BLOCK)
        starts = np.flatnonzero(first) * BLOCK
        for i in range(1, LAST):  # not across the begin of a run
            into[place.take(starts[starts >= i] - i), i * D :] = 0
        g["embed"] = _sums(x[0], into, order, self.rows).reshape(-1, LAST, D)
        for j in range(1, LAST):
            for i in range(j):  # what stands before a run is no place of its
                np.add.at(g["embed"][:, j], x[j][starts + i], d1[starts + i])
        return -float(logs.sum()) / m, g, touched

    def fit(self, y: np.ndarray, lengths: np.ndarray, adam: Adam, rate: float, seed: int = 0, steps: int | None = None) -> list[float]:
        """Adam on texts that stand one behind the other, in runs of RUN blocks: each token is learned from once, or, with
        ``steps``, as often as so many steps take, the rate falling to a tenth. Gives the losses."""
        if not lengths.sum():
            return []
        stream, place, first = spread(y, lengths)
        valid = np.zeros(len(stream), dtype=bool)
        valid[place] = True
        turn = np.arange(len(first)) - np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        starts = np.flatnonzero(turn % RUN == 0)
        sizes = np.diff(np.append(starts, len(first)))
        past = before(self.row(stream), first).reshape(LAST, -1, BLOCK)  # a run's first tokens know these, not the window
        stream, valid = stream.reshape(-1, BLOCK), valid.reshape(-1, BLOCK)
        draw, losses, done = np.random.default_rng(seed), [], 0
        while True:
            order = draw.permutation(len(starts))
            held = np.cumsum(sizes[order]) // (RUN * ROWS)
            bounds = np.append(np.flatnonzero(np.append(True, np.diff(held) > 0)), len(order))
            for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                own = order[a:z]
                size = sizes[own]
                blocks = np.repeat(starts[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                begins = np.zeros(len(blocks), dtype=bool)
                begins[np.cumsum(size) - size] = True
                at = np.flatnonzero(valid[blocks].ravel())
                deep = steps is not None or done % DEEP == 0
                loss, g, touched = self.gradients(past[:, blocks].reshape(LAST, -1), begins, at, stream[blocks].ravel()[at], deep)
                losses.append(loss)
                done += 1
                now = rate * min(1.0, len(blocks) / (RUN * ROWS))
                adam.step(g, touched, now if steps is None else now * (1 - 0.9 * done / steps))
                if done == steps:
                    return losses
            if steps is None:
                return losses

    def score(self, slots: np.ndarray, lengths: np.ndarray, at_once: int = 512) -> np.ndarray:
        """Natural log probability of each token of texts that stand one behind the other."""
        y, place, first = spread(slots, lengths)
        out = np.zeros(len(y), dtype=np.float32)
        valid = np.zeros(len(y), dtype=bool)
        valid[place] = True
        x = before(self.row(y), first)
        for lo in range(0, len(first), at_once):
            begin = max(0, lo - 1)  # the block before is seen, too
            part = slice(begin * BLOCK, (lo + at_once) * BLOCK)
            h, _ = self.states(x[:, part], first[begin : lo + at_once])
            own = lo * BLOCK + np.flatnonzero(valid[lo * BLOCK : (lo + at_once) * BLOCK])
            out[own] = self.log_probabilities(h.take(own - begin * BLOCK, axis=0), y[own])
        return out[place]
