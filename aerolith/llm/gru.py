"""The gated recurrent network of the language model, in numpy: forward steps,
truncated backpropagation, and a class-factored softmax over word ids.

Word ids are 0..V-1 with V = CLASSES * WIDTH; id // WIDTH is the class. A word's
probability is its class's times its own within the class, so a step costs two
softmaxes of about the root of V. The reset gate acts on the recurrent product
(one matrix product a step for all gates). States and gates are held units x
texts, so that every operation runs along the texts.
"""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np

CLASSES, WIDTH = 48, 48
VOCABULARY = CLASSES * WIDTH
HIDDEN = 16
#: Words of a window: gradients stop at its border, the state goes on.
WINDOW = 32
#: Texts side by side: at most while training, and while scoring.
STREAMS, ABREAST = 256, 1024
#: Windows a pass should have at least; short passes take fewer streams.
WINDOWS = 96
#: Targets of a class whose softmaxes are taken at once.
RUN = 512

Params = dict[str, np.ndarray]


def start(seed: int = 5) -> Params:
    rng = np.random.Generator(np.random.Philox(seed))
    w = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    z = lambda *shape: np.zeros(shape, np.float32)
    h = HIDDEN
    return {"x": w(VOCABULARY, 3 * h), "u": w(h, 3 * h), "b": z(3 * h), "bu": z(3 * h),
            "c": w(h, CLASSES), "bc": z(CLASSES),
            "o": w(CLASSES, h, WIDTH), "bo": z(CLASSES, WIDTH)}


def _inputs(p: Params, words: np.ndarray) -> np.ndarray:
    """The words' rows of the input table, steps x gates x texts."""
    return np.ascontiguousarray((p["x"][words] + p["b"]).transpose(0, 2, 1))


def step(p: Params, a: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """The next state, and what a gradient needs, from the inputs and the state."""
    n = HIDDEN
    u = p["u"].T @ h
    u += p["bu"][:, None]
    gates = a[:2 * n] + u[:2 * n]
    np.negative(gates, out=gates)
    np.exp(gates, out=gates)
    gates += 1
    np.reciprocal(gates, out=gates)
    z, r, un = gates[:n], gates[n:], u[2 * n:]
    new = r * un
    new += a[2 * n:]
    np.tanh(new, out=new)
    out = h - new
    out *= z
    out += new
    return out, z, r, new, un


def _by_class(p: Params, target: np.ndarray) -> tuple[np.ndarray, list]:
    """The targets' places in order of class, and runs of them (class, from, to,
    places within the class) with the weights of the class layer and of the
    class's own words side by side."""
    kind, own = target // WIDTH, target % WIDTH
    order = np.argsort(kind.astype(np.uint8), kind="stable")
    own, cuts, runs = own[order], np.searchsorted(kind[order], np.arange(CLASSES + 1)), []
    for k in np.flatnonzero(np.diff(cuts)):
        w = np.concatenate([p["c"], p["o"][k]], axis=1).T
        b = np.concatenate([p["bc"], p["bo"][k]])[:, None]
        for at in range(cuts[k], cuts[k + 1], RUN):
            to = min(at + RUN, cuts[k + 1])
            runs.append((k, at, to, own[at:to], w, b))
    return order, runs


def _softmaxes(w: np.ndarray, b: np.ndarray, s: np.ndarray, k: int, own: np.ndarray):
    """Both softmaxes of states (rows) whose targets are of class ``k``: the
    exponentials (class layer above the words), their sums, and each target's
    log-probability."""
    x = w @ s.T
    x += b
    x = x.reshape(2, -1, len(s))
    x -= x.max(1, keepdims=True)
    logs = x[0, k] + x[1, own, np.arange(len(s))]
    np.exp(x, out=x)
    sums = x.sum(1, keepdims=True)
    return x, sums, logs - np.log(sums[0, 0] * sums[1, 0])


def log_probabilities(p: Params, h: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log of each target word's probability, from the states (rows)."""
    order, runs = _by_class(p, target)
    s, out = h[order], np.empty(len(target))
    for k, at, to, own, w, b in runs:
        out[order[at:to]] = _softmaxes(w, b, s[at:to], k, own)[2]
    return out


def window_gradient(p: Params, words: np.ndarray, target: np.ndarray, fresh: np.ndarray,
                    h: np.ndarray) -> tuple[Params, np.ndarray, float]:
    """Gradient of the mean loss over a window: ``words``, ``target`` and ``fresh``
    are steps x streams; where ``fresh`` is set a text begins, so the state before
    that step is cleared. Returns the state to carry on."""
    n, (steps, streams), kind = HIDDEN, words.shape, p["u"].dtype
    a = _inputs(p, words)
    past = np.empty((steps, n, streams), kind)
    states = np.empty((steps, n, streams), kind)
    clears, kept = fresh.any(1), []
    for t in range(steps):
        past[t] = np.where(fresh[t], 0, h) if clears[t] else h
        h, *rest = step(p, a[t], past[t])
        states[t] = h
        kept.append(rest)
    g = {k: np.zeros_like(v) for k, v in p.items()}
    total = target.size
    # Output layers.
    order, runs = _by_class(p, target.ravel())
    rows = states.transpose(0, 2, 1).reshape(-1, n)[order]
    apart = np.empty_like(rows)
    loss = 0.0
    for k, at, to, own, w, b in runs:
        s = rows[at:to]
        d, sums, logs = _softmaxes(w, b, s, k, own)
        loss -= float(logs.sum())
        d *= 1 / (sums * total)
        d[0, k] -= 1 / total
        d[1, own, np.arange(to - at)] -= 1 / total
        d = d.reshape(CLASSES + WIDTH, -1)
        apart[at:to] = d.T @ w
        dw, db = (d @ s).T, d.sum(1)
        g["c"] += dw[:, :CLASSES]
        g["o"][k] += dw[:, CLASSES:]
        g["bc"] += db[:CLASSES]
        g["bo"][k] += db[CLASSES:]
    back = np.empty_like(rows)
    back[order] = apart
    back = np.ascontiguousarray(back.reshape(steps, streams, n).transpose(0, 2, 1))
    # Back through the window's steps.
    dx = np.empty((steps, 3 * n, streams), kind)
    du = np.empty((steps, 3 * n, streams), kind)
    carry = np.zeros((n, streams), kind)
    for t in range(steps - 1, -1, -1):
        z, r, new, un = kept[t]
        dh = back[t] + carry
        through = dh * z
        dn = (dh - through) * (1 - new * new)
        dx[t, :n] = (past[t] - new) * through * (1 - z)
        dx[t, n:2 * n] = dn * un * r * (1 - r)
        dx[t, 2 * n:] = dn
        du[t] = dx[t]
        du[t, 2 * n:] *= r
        carry = p["u"] @ du[t]
        carry += through
        if clears[t]:
            carry[:, fresh[t]] = 0
    across = lambda x: x.transpose(0, 2, 1).reshape(-1, x.shape[1])
    flat_du, flat_dx = across(du), across(dx)
    g["u"] = across(past).T @ flat_du
    g["bu"], g["b"] = flat_du.sum(0), flat_dx.sum(0)
    order = np.argsort(words.ravel().astype(np.uint16), kind="stable")
    ids = words.ravel()[order]
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    g["x"][ids[first]] = np.add.reduceat(flat_dx[order], first, axis=0)
    return g, h, loss / total


class Adam:
    def __init__(self, p: Params, rate: float):
        self.rate, self.t = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def update(self, p: Params, g: Params) -> None:
        self.t += 1
        norm = np.sqrt(sum(float(np.vdot(x, x)) for x in g.values()))
        scale = np.float32(min(1.0, 1.0 / max(norm, 1e-12)))
        rate = np.float32(self.rate * np.sqrt(1 - 0.99 ** self.t) / (1 - 0.9 ** self.t))
        for k, x in g.items():
            m, v = self.m[k], self.v[k]
            x *= scale
            m += np.float32(0.1) * (x - m)
            x *= x
            x -= v
            x *= np.float32(0.01)
            v += x
            np.sqrt(v, out=x)
            x += np.float32(1e-6)
            np.divide(m, x, out=x)
            x *= rate
            p[k] -= x


def keep_memory() -> None:
    """Let the process keep freed arrays of a window for the next one: returning
    them to the system and faulting them in again takes half of a pass."""
    with contextlib.suppress(AttributeError, OSError):  # not every C library has it
        trim_threshold, mmap_threshold = -1, -3
        libc = ctypes.CDLL(None)
        libc.mallopt(trim_threshold, 1 << 28)
        libc.mallopt(mmap_threshold, 1 << 27)


def train(p: Params, whole: np.ndarray, end: int, rate: float) -> tuple[Params, int]:
    """One pass over texts' word ids, one text behind the other, each closed by
    ``end``: cut into streams that run side by side, the state cleared where a
    text begins. The words left over when the streams are cut pass last."""
    p = {k: v.copy() for k, v in p.items()}
    if not len(whole):
        return p, 0
    streams = int(np.clip(len(whole) // (WINDOW * WINDOWS), 1, STREAMS))
    adam, length = Adam(p, rate), len(whole) // streams
    parts = [whole[:length * streams].reshape(streams, length).T, whole[length * streams:, None]]
    for part in parts:
        h = np.zeros((HIDDEN, part.shape[1]), np.float32)
        last = np.full((1, part.shape[1]), end)
        for at in range(0, len(part), WINDOW):
            target = part[at:at + WINDOW].astype(np.int64)
            words = np.concatenate([last, target[:-1]])
            g, h, _ = window_gradient(p, words, target, words == end, h)
            adam.update(p, g)
            last = target[-1:]
    return p, len(whole)


def score(p: Params, ids: np.ndarray, offs: np.ndarray, end: int) -> np.ndarray:
    """Natural log-likelihood of each whole text: its word ids, then ``end``.

    Texts of like length run side by side; each window's states are scored at
    once and the state is carried into the next window."""
    lens = np.diff(offs) + 1
    order = np.argsort(-lens, kind="stable")
    out = np.zeros(len(lens))
    upto = np.append(ids, end)
    for group in range(0, len(order), ABREAST):
        mine = order[group:group + ABREAST]
        size, at = lens[mine], offs[:-1][mine]
        h = np.zeros((HIDDEN, len(mine)), np.float32)
        last = np.full(len(mine), end, np.int64)
        for t0 in range(0, int(size[0]), WINDOW):
            n = int(np.searchsorted(-size, -t0, "left"))  # texts of more than t0 words
            steps = min(WINDOW, int(size[0]) - t0)
            t = np.arange(t0, t0 + steps)[:, None]
            target = np.where(t >= size[:n] - 1, end, upto[np.minimum(at[:n] + t, len(ids))])
            words = np.concatenate([last[None, :n], target[:-1]])
            a, h = _inputs(p, words), h[:, :n]
            states = np.empty((steps, n, HIDDEN), np.float32)
            for i in range(steps):
                h = step(p, a[i], h)[0]
                states[i] = h.T
            live = (t < size[:n]).ravel()
            who = np.broadcast_to(np.arange(n), (steps, n)).ravel()[live]
            logs = log_probabilities(p, states.reshape(-1, HIDDEN)[live], target.ravel()[live])
            out[mine[:n]] += np.bincount(who, logs, minlength=n)
            last = target[-1].astype(np.int64)
    return out
