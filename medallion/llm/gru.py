"""A gated recurrent network over word symbols with a class-factored output softmax, in numpy.

Symbols are ``CLUSTERS * MEMBERS`` head words, of which 0 ends a document, then ``TAILS`` tail classes.  The output
is a softmax over clusters and tail classes, times a softmax over the cluster's members for a head word.
Streams are worked on in windows; the state goes on from one window to the next and is cleared where a document
begins, so a document's log-likelihood is that of the whole of it.
"""

from __future__ import annotations

import heapq

import numpy as np

HIDDEN, CLUSTERS, MEMBERS, TAILS = 24, 32, 32, 32
HEAD, KINDS = CLUSTERS * MEMBERS, CLUSTERS + TAILS
SYMBOLS = HEAD + TAILS
END = 0
F4 = np.float32


def initial(head_counts: np.ndarray, tail_counts: np.ndarray) -> dict[str, np.ndarray]:
    """Small random weights, and biases that give the corpus's unigram distribution."""
    draw = np.random.default_rng(11)
    head = head_counts.reshape(CLUSTERS, MEMBERS) + 0.1
    kinds = np.concatenate([head.sum(1), tail_counts + 0.5])
    small = lambda *shape: draw.normal(0, 0.1, shape).astype(F4)
    return {"x": small(SYMBOLS, 3 * HIDDEN), "u": small(HIDDEN, 3 * HIDDEN), "c": small(HIDDEN, KINDS) * F4(0.1),
            "cb": np.log(kinds / kinds.sum()).astype(F4), "w": small(CLUSTERS, HIDDEN, MEMBERS) * F4(0.1),
            "wb": np.log(head / head.sum(1, keepdims=True)).astype(F4)}


def pack(params: dict[str, np.ndarray]) -> bytes:
    return b"".join(params[k].tobytes() for k in sorted(params))


def unpack(held: bytes, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    flat, out, at = np.frombuffer(held, F4), {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).copy()
        at += like[k].size
    return out


class Lanes:
    """Documents laid out in lanes, as steps by lanes; documents stay whole.  Only one window is held at a time."""

    def __init__(self, sizes: np.ndarray, n: int):
        heap = [(0, i) for i in range(max(1, min(n, len(sizes))))]
        held: list[list[int]] = [[] for _ in heap]
        for doc in np.argsort(-sizes, kind="stable"):
            length, lane = heapq.heappop(heap)
            held[lane].append(doc)
            heapq.heappush(heap, (length + int(sizes[doc]), lane))
        docs = np.array([doc for lane in held for doc in lane], np.int64)
        # where documents begin when lanes lie one after another, and how far that is from where they lie
        self.begins = np.cumsum(sizes[docs]) - sizes[docs]
        self.shifts = (np.cumsum(sizes) - sizes)[docs] - self.begins
        self.lengths = np.array([length for length, _ in sorted(heap, key=lambda x: x[1])])
        self.steps = int(self.lengths.max())

    def windows(self, steps: int):
        """Flat token positions of each window, -1 where a lane has ended, and which lanes of the window before go on."""
        lane, firsts = np.arange(len(self.lengths)), np.cumsum(self.lengths) - self.lengths
        for at in range(0, self.steps, steps):
            live = self.lengths[lane] > at
            lane = lane[live]
            step = np.arange(at, min(at + steps, self.steps))[:, None]
            place = firsts[lane] + step
            place += self.shifts[np.searchsorted(self.begins, place, "right") - 1]
            yield np.where(step < self.lengths[lane], place, -1), live


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return F4(1) / (F4(1) + np.exp(-x))


def forward(p: dict, symbols: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: bool = False):
    """States behind each step of a window (steps x lanes), and with ``keep`` what the way back needs."""
    t_max, n = symbols.shape
    states = np.empty((t_max, n, HIDDEN), F4)
    tape = tuple(np.empty((t_max, n, k * HIDDEN), F4) for k in (1, 2, 1, 1)) if keep else ()
    inputs, begins = p["x"][symbols], fresh.any(axis=1)
    for t in range(t_max):
        if begins[t]:
            h = np.where(fresh[t][:, None], F4(0), h)
        x, hu = inputs[t], h @ p["u"]
        gates = _sigmoid(x[:, :2 * HIDDEN] + hu[:, :2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        new = F4(2) * _sigmoid(F4(2) * (x[:, 2 * HIDDEN:] + r * hu[:, 2 * HIDDEN:])) - F4(1)
        if keep:
            for held, value in zip(tape, (h, gates, new, hu[:, 2 * HIDDEN:]), strict=True):
                held[t] = value
        h = new + z * (h - new)
        states[t] = h
    return states, h, tape


def _log_softmax(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    logits -= logits.max(axis=1, keepdims=True)
    e = np.exp(logits)
    total = e.sum(axis=1, keepdims=True)
    return np.log(total)[:, 0], e / total


def log_probs(p: dict, h: np.ndarray, targets: np.ndarray, grads: dict | None = None):
    """Natural log probability of each target symbol (a tail symbol's is its class's).

    With ``grads`` also adds the gradient of the negative mean, and returns it for the states.
    """
    head = targets < HEAD
    kinds = np.where(head, targets // MEMBERS, targets - HEAD + CLUSTERS)
    rows = np.arange(len(targets))
    logits = h @ p["c"] + p["cb"]
    logits -= logits.max(axis=1, keepdims=True)
    chosen = logits[rows, kinds]
    total, soft = _log_softmax(logits)
    found = chosen - total
    dh = None
    if grads is not None:
        scale = F4(1 / len(targets))
        soft[rows, kinds] -= F4(1)
        soft *= scale
        grads["c"] += h.T @ soft
        grads["cb"] += soft.sum(0)
        dh = soft @ p["c"].T
    order = np.flatnonzero(head)
    order = order[np.argsort(kinds[order], kind="stable")]
    cuts = np.searchsorted(kinds[order], np.arange(CLUSTERS + 1))
    for k in range(CLUSTERS):
        own = order[cuts[k]:cuts[k + 1]]
        if not len(own):
            continue
        hk, member = h[own], targets[own] % MEMBERS
        logits = hk @ p["w"][k] + p["wb"][k]
        logits -= logits.max(axis=1, keepdims=True)
        chosen = logits[np.arange(len(own)), member]
        total, soft = _log_softmax(logits)
        found[own] += chosen - total
        if grads is not None:
            soft[np.arange(len(own)), member] -= F4(1)
            soft *= scale
            grads["w"][k] += hk.T @ soft
            grads["wb"][k] += soft.sum(0)
            dh[own] += soft @ p["w"][k].T
    return found, dh


def backward(p: dict, symbols: np.ndarray, fresh: np.ndarray, tape: tuple, dstates: np.ndarray, grads: dict) -> None:
    """Back through the steps of one window; nothing goes further back than its beginning."""
    t_max, n = symbols.shape
    h, gates, new, hun = tape
    z, r = gates[:, :, :HIDDEN], gates[:, :, HIDDEN:]
    # what the gradient of a state is multiplied by on its way to the new value, to z, and from the new value to r
    to_new, to_z, to_r = (F4(1) - z) * (F4(1) - new * new), (h - new) * z * (F4(1) - z), hun * r * (F4(1) - r)
    dx = np.empty((t_max, n, 3 * HIDDEN), F4)
    dhu = np.empty_like(dx)
    dh = np.zeros((n, HIDDEN), F4)
    back, begins = np.ascontiguousarray(p["u"].T), fresh.any(axis=1)
    for t in range(t_max - 1, -1, -1):
        dh = dh + dstates[t]
        dnew = dh * to_new[t]
        step = dhu[t]
        step[:, :HIDDEN] = dh * to_z[t]
        step[:, HIDDEN:2 * HIDDEN] = dnew * to_r[t]
        step[:, 2 * HIDDEN:] = dnew * r[t]
        dx[t, :, 2 * HIDDEN:] = dnew
        dh = dh * z[t] + step @ back
        if begins[t]:
            dh = np.where(fresh[t][:, None], F4(0), dh)
    dx[:, :, :2 * HIDDEN] = dhu[:, :, :2 * HIDDEN]
    grads["u"] += h.reshape(-1, HIDDEN).T @ dhu.reshape(-1, 3 * HIDDEN)
    flat, ids = dx.reshape(-1, 3 * HIDDEN), symbols.ravel()
    order = np.argsort(ids, kind="stable")
    firsts = np.flatnonzero(np.concatenate([[True], np.diff(ids[order]) > 0]))
    grads["x"][ids[order][firsts]] += np.add.reduceat(flat[order], firsts)


def stream(symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets and beginnings of documents whose symbols (without ends) lie one after another.

    ``sizes`` are the documents' symbols with one end each.
    """
    ends = np.cumsum(sizes) - 1
    targets = np.full(int(sizes.sum()), END, np.int64)
    inside = np.ones(len(targets), bool)
    inside[ends] = False
    targets[inside] = symbols
    inputs = np.empty_like(targets)
    inputs[1:] = targets[:-1]
    fresh = np.zeros(len(targets), bool)
    fresh[ends - sizes + 1] = True
    inputs[fresh] = END
    return inputs, targets, fresh


def score(p: dict, symbols: np.ndarray, sizes: np.ndarray, n_lanes: int = 256, window: int = 64) -> np.ndarray:
    """Natural log-likelihood of each whole document's symbols."""
    inputs, targets, fresh = stream(symbols, sizes)
    laid = Lanes(sizes, n_lanes)
    found = np.zeros(len(targets))
    h = np.zeros((len(laid.lengths), HIDDEN), F4)
    for part, live in laid.windows(window):
        h = h[live]  # lanes end one by one
        states, h, _ = forward(p, inputs[part], fresh[part] & (part >= 0), h)
        real = part >= 0
        found[part[real]] = log_probs(p, states[real], targets[part[real]])[0]
    return np.add.reduceat(found, np.cumsum(sizes) - sizes)


def train(p: dict, symbols: np.ndarray, sizes: np.ndarray, n_lanes: int = 256, window: int = 32, rate: float = 0.01) -> dict:
    """One pass of truncated backpropagation with Adam over the documents; returns new weights."""
    inputs, targets, fresh = stream(symbols, sizes)
    laid = Lanes(sizes, n_lanes)
    p = {k: v.copy() for k, v in p.items()}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    h = np.zeros((len(laid.lengths), HIDDEN), F4)
    steps = max(1, -(-laid.steps // window))
    for step, (part, live) in enumerate(laid.windows(window), 1):
        h, real = h[live], part >= 0
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        states, h, tape = forward(p, inputs[part], fresh[part] & real, h, keep=True)
        dstates = np.zeros_like(states)
        dstates[real] = log_probs(p, states[real], targets[part[real]], grads)[1]
        backward(p, inputs[part], fresh[part] & real, tape, dstates, grads)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        pace = rate * (1 - step / (steps + 1)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        for k, g in grads.items():
            if norm > 1:
                g /= F4(norm)
            first[k] += F4(0.1) * (g - first[k])
            second[k] += F4(0.001) * (g * g - second[k])
            p[k] -= F4(pace) * first[k] / (np.sqrt(second[k]) + F4(1e-8))
    return p
