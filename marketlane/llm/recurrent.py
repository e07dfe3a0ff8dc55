"""A gated recurrent network over token codes in numpy, with class-factored output.

Codes: 0 to ``heads - 1`` are frequent tokens, each with an input and an output
of its own; then ``spellings`` codes for rarer tokens and as many for tokens
that are new, by how they are spelt; then, with a ``depth``, ``leaves`` codes
for each spelling, so that a rarer token is told from others of its spelling.
The output is the softmax of a class (blocks of ``width`` frequent tokens, each
spelling, and one class for all new tokens) times, for a frequent token, the
softmax within its class, and for a rarer one the turns to its leaf in a binary
tree of its spelling. As input it has the vector of its spelling and its own.

Documents are packed into lanes, each document whole and in order. All lanes
step together; a window's last state is the next window's first, and a
document's first token starts from a state of zeros. So a document's
log-likelihood is that of the complete document. Training goes back through the
steps of one window (truncated backpropagation), with steps of Adagrad.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

UNITS = 16
WINDOW = 16
# Steps that scoring takes at a time, which the scores do not depend on.
SCORED = 48
LANES = 256
LEAST_LANES = 16
RATE = 0.2
CLIP = 5.0
# Windows that each lane has at least where a block is small, so that there are steps to learn from.
LEAST_WINDOWS = 24
# Rows that one small matrix product adds up by id.
RUN = 16
_LOW = -30.0
_HIGH = np.float32(80)  # exp stays finite
# Levels of the trees, from the root, whose nodes are all worked out for each row; of the rest only those passed.
TOP = 5
# What the sums of squares start from: of all weights, and of those of leaves, which few steps change.
SQUARES, LEAF_SQUARES = 1e-4, 1e-6


@dataclass(frozen=True)
class Shape:
    heads: int
    width: int
    spellings: int
    depth: int = 0

    @property
    def leaves(self) -> int:
        """Leaves of a spelling's tree."""
        return 1 << self.depth

    @property
    def first_leaf(self) -> int:
        return self.heads + 2 * self.spellings

    @property
    def head_classes(self) -> int:
        return -(-self.heads // self.width)

    @property
    def classes(self) -> int:
        return self.head_classes + self.spellings + 1

    def sizes(self) -> dict[str, tuple[int, ...]]:
        h, leaves = UNITS, self.spellings * self.leaves
        # Nodes of a tree are numbered from 1, the children of k are 2 k and 2 k + 1.
        trees = {"l": (leaves, 3 * h), "t": (leaves, h), "t0": (leaves,)} if self.depth else {}
        return trees | {
            "x": (self.heads + self.spellings, 3 * h),
            "u": (h, 3 * h),
            "u0": (3 * h,),
            "c": (h, self.classes),
            "c0": (self.classes,),
            "w": (self.head_classes, h, self.width),
            "w0": (self.head_classes, self.width),
        }


Model = dict[str, np.ndarray]


def start(shape: Shape, head_counts: np.ndarray, spelling_counts: np.ndarray, new: float, leaf_counts: np.ndarray | None = None) -> Model:
    """A model that gives every token its share of the corpus, whatever went before."""
    rng = np.random.default_rng(11)
    zeros = ("u0", "c", "w", "l", "t", "t0")
    model = {k: np.zeros(s, np.float32) if k in zeros else rng.normal(0, 0.1, s).astype(np.float32) for k, s in shape.sizes().items()}
    if shape.depth and leaf_counts is not None:
        model["t0"][:] = _turns(shape, leaf_counts)
    held = np.zeros((shape.head_classes, shape.width))
    held.flat[: len(head_counts)] = head_counts
    per_class = np.concatenate([held.sum(1), spelling_counts, [new]])
    with np.errstate(divide="ignore"):
        model["c0"][:] = np.maximum(np.log(per_class / max(per_class.sum(), 1)), _LOW)
        model["w0"][:] = np.maximum(np.log(held / np.maximum(held.sum(1, keepdims=True), 1)), _LOW)
    return model


def _turns(shape: Shape, leaf_counts: np.ndarray) -> np.ndarray:
    """For each node of the trees, the log-odds of the second child."""
    sums = np.zeros((shape.spellings, 2 * shape.leaves))
    sums[:, shape.leaves :] = leaf_counts.reshape(shape.spellings, shape.leaves)
    for level in reversed(range(shape.depth)):
        nodes = np.arange(1 << level, 2 << level)
        sums[:, nodes] = sums[:, 2 * nodes] + sums[:, 2 * nodes + 1]
    left, right = sums[:, 0::2], sums[:, 1::2]
    with np.errstate(divide="ignore", invalid="ignore"):
        odds = np.clip(np.log(right) - np.log(left), _LOW, -_LOW)
    odds[(left == 0) & (right == 0)] = 0
    odds[:, 0] = 0  # there is no node 0
    return odds.ravel()


def packed(model: Model) -> np.ndarray:
    return np.concatenate([model[k].ravel() for k in sorted(model)])


def unpacked(flat: np.ndarray, shape: Shape) -> Model:
    out, at = {}, 0
    for k, s in sorted(shape.sizes().items()):
        n = int(np.prod(s))
        out[k] = flat[at : at + n].astype(np.float32).reshape(s)
        at += n
    return out


def sums_by_id(ids: np.ndarray, values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ids there are, and the weighted sum of each one's rows of ``values``.

    ``ids`` (and ``weights``) are levels by rows, each level in order, with no id on two levels.
    Runs of rows are multiplied by a small matrix with a line for each id of the run;
    ids that go on in further runs get the rest by ``reduceat``.
    """
    levels, n = ids.shape
    runs, width = -(-n // RUN), values.shape[1]
    fresh = np.ones(ids.shape, bool)
    np.not_equal(ids[:, 1:], ids[:, :-1], out=fresh[:, 1:])
    begins = fresh.copy()
    begins[:, ::RUN] = True
    piece = np.cumsum(begins, axis=1, dtype=np.int32)
    row = np.arange(n)
    line = (piece - piece[:, ::RUN].repeat(RUN, axis=1)[:, :n]) + (row // RUN * levels + np.arange(levels)[:, None]) * RUN
    table = np.zeros(runs * levels * RUN * RUN, np.float32)
    table[line * RUN + row % RUN] = 1 if weights is None else weights
    if runs * RUN > n:
        values = np.concatenate([values, np.zeros((runs * RUN - n, width), values.dtype)])
    part = np.matmul(table.reshape(runs, levels * RUN, RUN), values.reshape(runs, RUN, width)).reshape(-1, width)
    at = np.flatnonzero(begins)
    line, first = line.ravel().take(at), fresh.ravel().take(at)
    sums = part.take(line[first], axis=0)
    rest = np.flatnonzero(~first)
    if len(rest):
        owner = np.cumsum(first)[rest] - 1
        edge = np.flatnonzero(np.diff(owner, prepend=-1))
        sums[owner[edge]] += np.add.reduceat(part.take(line[rest], axis=0), edge, axis=0)
    return ids.ravel().take(at[first]), sums


class Lanes:
    """Documents' codes laid out in lanes, longest lane first."""

    def __init__(self, codes: np.ndarray, sizes: np.ndarray, lanes: int) -> None:
        loads = [(0, k) for k in range(lanes)]
        held: list[list[int]] = [[] for _ in range(lanes)]
        for d in np.argsort(-sizes, kind="stable").tolist():
            load, k = heapq.heappop(loads)
            held[k].append(d)
            heapq.heappush(loads, (load + int(sizes[d]), k))
        length = sorted(((load, k) for load, k in loads if load), reverse=True)
        docs = np.array([d for _, k in length for d in held[k]], np.int64)
        first = np.cumsum(sizes) - sizes
        own = sizes[docs]
        self.docs = docs
        self.starts = np.cumsum(own) - own
        place = np.repeat(first[docs] - self.starts, own) + np.arange(int(own.sum()))
        self.codes = codes[place]
        self.opens = np.zeros(len(place), bool)
        self.opens[self.starts] = True
        # What goes in before each token: the token before it in its document, else the end.
        self.last = np.zeros_like(self.codes)
        self.last[1:] = self.codes[:-1]
        self.last[self.starts] = 0
        self.length = np.array([n for n, _ in length], np.int64)
        self.first = np.cumsum(self.length) - self.length

    def windows(self, size: int = WINDOW) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of the tokens of each window (steps by lanes), and which of them there are."""
        steps = np.arange(size)[:, None]
        for at in range(0, int(self.length.max(initial=0)), size):
            n = int(np.searchsorted(-self.length, -at))
            there = at + steps < self.length[:n]
            yield np.where(there, self.first[:n] + at + steps, self.first[:n]), there


def lanes_for(sizes: np.ndarray, most: int) -> int:
    """As many lanes as the longest document lets fill evenly."""
    return max(min(LEAST_LANES, most), min(most, int(sizes.sum()) // max(1, int(sizes.max(initial=0)))))


class Network:
    def __init__(self, shape: Shape, model: Model) -> None:
        self.shape = shape
        self.m = dict(model)
        self.squares = {k: np.full(v.shape, LEAF_SQUARES if k in ("l", "t", "t0") else SQUARES, np.float32) for k, v in model.items()}
        # By code: its input, its class, its leaf (for codes without one a row of zeros after all leaves).
        leaves = shape.spellings * shape.leaves if shape.depth else 0
        codes = np.arange(shape.first_leaf + leaves)
        spelt = np.where(codes < shape.first_leaf, codes, shape.heads + (codes - shape.first_leaf >> shape.depth))
        rare = np.minimum(spelt - shape.heads, shape.spellings) + shape.head_classes
        self._input = np.where(spelt < shape.heads + shape.spellings, spelt, spelt - shape.spellings)
        self._class = np.where(spelt < shape.heads, spelt // shape.width, rare)
        self._leaf = np.where(codes < shape.first_leaf, leaves, codes - shape.first_leaf)
        if shape.depth:
            self._own = np.concatenate([model["l"], np.zeros((1, 3 * UNITS), np.float32)])
            self.m["l"] = self._own[:-1]

    def _bias(self) -> np.ndarray:
        """What both gates have whatever comes in; the new state's is damped with the old state."""
        bias = self.m["u0"].copy()
        bias[2 * UNITS :] = 0
        return bias

    def _forward(self, lanes: Lanes, place: np.ndarray, h: np.ndarray, inputs: np.ndarray | None = None) -> tuple:
        """States and gates of a window, as steps by features by lanes; ``h`` is the state before it.

        With ``inputs``, those of every code, what backpropagation needs is kept for one step only.
        """
        m, n, keep = self.m, UNITS, inputs is None
        steps, width = place.shape
        opens, last = lanes.opens[place], lanes.last[place]
        if inputs is None:
            gates = (m["x"] + self._bias()).take(self._input.take(last), axis=0)
            if self.shape.depth:
                gates += self._own.take(self._leaf.take(last), axis=0)
        else:
            gates = inputs.take(last, axis=0)
        gates = np.ascontiguousarray(gates.transpose(0, 2, 1))
        states = np.empty((steps, n, width), np.float32)
        olds, inner = (np.empty((steps if keep else 1, n, width), np.float32) for _ in range(2))
        u, u0 = np.ascontiguousarray(m["u"].T), m["u0"][2 * n :, None]
        u[: 2 * n] *= -1  # the gates are 1 / (1 + exp(-x - u h))
        a, b = np.empty((3 * n, width), np.float32), np.empty((n, width), np.float32)
        opened = opens.any(axis=1).tolist()
        for t in range(steps):
            old = olds[t if keep else 0]
            old[:] = h
            if opened[t]:
                old[:, opens[t]] = 0
            np.matmul(u, old, out=a)
            into = inner[t if keep else 0]
            np.add(a[2 * n :], u0, out=into)
            g = gates[t]
            both, fresh = g[: 2 * n], g[2 * n :]
            np.subtract(a[: 2 * n], both, out=both)
            np.exp(np.minimum(both, _HIGH, out=both), out=both)
            both += 1
            np.reciprocal(both, out=both)
            np.multiply(g[:n], into, out=b)
            fresh += b
            np.tanh(fresh, out=fresh)
            h = states[t]
            np.subtract(old, fresh, out=h)
            h *= g[n : 2 * n]
            h += fresh
        return last, states, gates, olds, inner

    def _ordered(self, codes: np.ndarray, states: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The codes of the tokens that there are in order, their places among all steps and lanes, and the states before them."""
        places = np.flatnonzero(there)
        # 16 bits are sorted by their digits.
        order = np.argsort(codes.astype(np.int16) if len(self._class) <= 1 << 15 else codes, kind="stable")
        places = places.take(order)
        rows = np.ascontiguousarray(states.transpose(0, 2, 1)).reshape(-1, UNITS)
        return codes.take(order), places, rows.take(places, axis=0)

    @staticmethod
    def _softmax(z: np.ndarray, target: np.ndarray, keep: bool = False) -> np.ndarray:
        """Log-probability of each column's target; with ``keep``, the errors of the columns (in place)."""
        z -= z.max(axis=0)
        columns = np.arange(len(target))
        if not keep:
            logs = z[target, columns]
            np.exp(z, out=z)
            return logs - np.log(z.sum(axis=0))
        np.exp(z, out=z)
        z /= z.sum(axis=0)
        z[target, columns] -= 1
        return z

    def _class_terms(self, rows: np.ndarray, codes: np.ndarray, keep: bool = False) -> np.ndarray:
        z = self.m["c"].T @ rows.T
        z += self.m["c0"][:, None]
        return self._softmax(z, self._class.take(codes), keep)

    def _by_class(self, codes: np.ndarray) -> Iterator[tuple[int, slice]]:
        """The slices of the ordered codes that each class of frequent tokens has."""
        s = self.shape
        edge = np.searchsorted(codes, np.minimum(np.arange(s.head_classes + 1) * s.width, s.heads)).tolist()
        for k in range(s.head_classes):
            if edge[k] < edge[k + 1]:
                yield k, slice(edge[k], edge[k + 1])

    def _word_terms(self, rows: np.ndarray, codes: np.ndarray, keep: bool = False) -> np.ndarray:
        """For frequent tokens in the order of their codes, as ``_softmax`` has it, within their classes."""
        z = np.empty((self.shape.width, len(codes)), np.float32)
        for k, own in self._by_class(codes):
            np.matmul(self.m["w"][k].T, rows[own].T, out=z[:, own])
            z[:, own] += self.m["w0"][k][:, None]
        return self._softmax(z, codes % self.shape.width, keep)

    def _by_tree(self, leaf: np.ndarray) -> Iterator[tuple[int, slice]]:
        """The slices of the ordered leaves that each spelling has."""
        s = self.shape
        edge = np.searchsorted(leaf, np.arange(s.spellings + 1) << s.depth).tolist()
        for k in range(s.spellings):
            if edge[k] < edge[k + 1]:
                yield k, slice(edge[k], edge[k + 1])

    def _leaf_terms(self, leaf: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For rows in the order of their leaves, by level and row: the nodes passed, the weights of those below
        the top, the log-odds against the turn taken, and the turn; and where the top's are among its nodes by row."""
        s, m = self.shape, self.m
        top = min(TOP, s.depth)
        tree, at = leaf >> s.depth << s.depth, (leaf & (s.leaves - 1)) + s.leaves
        down = np.arange(s.depth, 0, -1, dtype=leaf.dtype)[:, None]
        at_level = at >> down
        nodes = at_level + tree
        turn = (at >> (down - 1) & 1).astype(np.float32)
        every = np.empty((len(leaf), 1 << top), np.float32)
        trees = m["t"].reshape(s.spellings, s.leaves, UNITS)
        for k, own in self._by_tree(leaf):
            np.matmul(rows[own], trees[k, : 1 << top].T, out=every[own])
        where = at_level[:top] + (np.arange(len(leaf)) << top)
        weights = m["t"].take(nodes[top:], axis=0)
        z = m["t0"].take(nodes)
        z[:top] += every.take(where)
        z[top:] += np.einsum("dnh,nh->dn", weights, rows)
        z *= 1 - 2 * turn
        return nodes, weights, z, turn, where

    def _learn_leaves(self, leaf: np.ndarray, rows: np.ndarray, back: np.ndarray, grad: dict) -> None:
        """Adds the errors of the states to ``back``, and the gradients of the trees to ``grad``."""
        s, m = self.shape, self.m
        top = min(TOP, s.depth)
        nodes, weights, error, turn, where = self._leaf_terms(leaf, rows)
        # sigmoid(z) (1 - 2 turn), where z is the log-odds against the turn.
        error *= np.float32(0.5)
        np.tanh(error, out=error)
        error += 1
        np.subtract(np.float32(0.5), turn, out=turn)
        error *= turn
        edge = np.flatnonzero(np.diff(nodes.ravel(), prepend=-1))
        # Each level's nodes are in order, and no node is on two levels.
        grad["t0"] = nodes.ravel()[edge], np.add.reduceat(error.ravel(), edge)
        every = np.zeros((len(leaf), 1 << top), np.float32)
        every.ravel()[where] = error[:top]
        trees = m["t"].reshape(s.spellings, s.leaves, UNITS)
        ids, sums = [], []
        for k, own in self._by_tree(leaf):
            ids.append(np.arange(1 << top) + (k << s.depth))
            sums.append(every[own].T @ rows[own])
            back[own] += every[own] @ trees[k, : 1 << top]
        if top < s.depth:
            back += np.einsum("dnh,dn->hn", weights, error[top:]).T
            below = sums_by_id(nodes[top:], rows, error[top:])
            ids.append(below[0])
            sums.append(below[1])
        grad["t"] = np.concatenate(ids), np.concatenate(sums)

    def _first_leaf(self, codes: np.ndarray) -> int:
        return int(np.searchsorted(codes, self.shape.first_leaf))

    def score(self, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Natural log-likelihood of each document's codes."""
        lanes = Lanes(codes, sizes, lanes_for(sizes, LANES))
        logs = np.zeros(len(lanes.codes))
        h = np.zeros((UNITS, len(lanes.length)), np.float32)
        inputs = (self.m["x"] + self._bias())[self._input]
        if self.shape.depth:
            inputs += self._own[self._leaf]
        for place, there in lanes.windows(SCORED):
            _, states, *_ = self._forward(lanes, place, h[:, : place.shape[1]], inputs)
            h = states[-1]
            target, at, rows = self._ordered(lanes.codes[place[there]], states, there)
            found = self._class_terms(rows, target)
            lo = int(np.searchsorted(target, self.shape.heads))
            found[:lo] += self._word_terms(rows[:lo], target[:lo])
            lo = self._first_leaf(target)
            if lo < len(target):
                z = self._leaf_terms(target[lo:].astype(np.int64) - self.shape.first_leaf, rows[lo:])[2]
                found[lo:] -= (np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z)))).sum(axis=0)
            logs[place.ravel()[at]] = found
        out = np.zeros(len(sizes))
        out[lanes.docs] = np.add.reduceat(logs, lanes.starts) if len(logs) else 0
        return out

    def train(self, codes: np.ndarray, sizes: np.ndarray) -> None:
        """One pass over the documents."""
        lanes = Lanes(codes, sizes, lanes_for(sizes, max(1, min(LANES, len(codes) // (WINDOW * LEAST_WINDOWS)))))
        h = np.zeros((UNITS, len(lanes.length)), np.float32)
        for place, there in lanes.windows():
            h = self._learn(lanes, place, there, h[:, : place.shape[1]])

    def _learn(self, lanes: Lanes, place: np.ndarray, there: np.ndarray, h: np.ndarray) -> np.ndarray:
        m, n, s = self.m, UNITS, self.shape
        last, states, gates, olds, inner = self._forward(lanes, place, h)
        target, at, rows = self._ordered(lanes.codes[place[there]], states, there)
        # A window that few lanes reach counts for as much less.
        share = np.float32(1 / (WINDOW * len(lanes.length)))
        error = self._class_terms(rows, target, keep=True)
        grad = {"c": rows.T @ error.T, "c0": error.sum(axis=1), "w": np.zeros_like(m["w"]), "w0": np.zeros_like(m["w0"])}
        back = error.T @ m["c"].T
        lo = int(np.searchsorted(target, s.heads))
        error = self._word_terms(rows[:lo], target[:lo], keep=True)
        for k, own in self._by_class(target):
            mine = error[:, own].T
            grad["w"][k] = rows[own].T @ mine
            grad["w0"][k] = mine.sum(axis=0)
            back[own] += mine @ m["w"][k].T
        lo = self._first_leaf(target)
        if lo < len(target):
            self._learn_leaves(target[lo:].astype(np.int64) - s.first_leaf, rows[lo:], back[lo:], grad)
        if there.all():
            placed = np.empty_like(at)
            placed[at] = np.arange(len(at))
            d_rows = back.take(placed, axis=0)
        else:
            d_rows = np.zeros((there.size, n), np.float32)
            d_rows[at] = back
        d_states = np.ascontiguousarray(d_rows.reshape(*place.shape, n).transpose(0, 2, 1))
        d_inner = np.empty(gates.shape, np.float32)  # of u h + u0
        d_fresh = np.empty(states.shape, np.float32)
        dh = np.zeros_like(states[0])
        opens = lanes.opens[place]
        opened = opens.any(axis=1).tolist()
        reset, keep, fresh = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
        slope = gates[:, : 2 * n] * (1 - gates[:, : 2 * n])
        curve = (1 - keep) * (1 - fresh * fresh)
        inner *= slope[:, :n]
        change = (olds - fresh) * slope[:, n:]
        b = np.empty_like(dh)
        for t in range(len(place) - 1, -1, -1):
            dh += d_states[t]
            di, df = d_inner[t], d_fresh[t]
            np.multiply(dh, curve[t], out=df)
            np.multiply(df, reset[t], out=di[2 * n :])
            np.multiply(df, inner[t], out=di[:n])
            np.multiply(dh, change[t], out=di[n : 2 * n])
            dh *= keep[t]
            np.matmul(m["u"], di, out=b)
            dh += b
            if opened[t]:
                dh[:, opens[t]] = 0
        by_row = np.ascontiguousarray(d_inner.transpose(0, 2, 1)).reshape(-1, 3 * n)
        grad["u"] = olds.transpose(0, 2, 1).reshape(-1, n).T @ by_row
        grad["u0"] = by_row.sum(axis=0)
        by_row.reshape(*place.shape, 3 * n)[:, :, 2 * n :] = d_fresh.transpose(0, 2, 1)
        last = last.ravel()
        order = np.argsort(last, kind="stable")
        codes, d_input = sums_by_id(last.take(order)[None], by_row.take(order, axis=0))
        lo = self._first_leaf(codes)
        if lo < len(codes):
            grad["l"] = codes[lo:].astype(np.int64) - s.first_leaf, d_input[lo:]
        lo = int(np.searchsorted(codes, s.heads))
        which = self._input.take(codes[lo:]) == np.arange(s.heads, s.heads + s.spellings)[:, None]
        grad["x"] = np.concatenate([d_input[:lo], which.astype(np.float32) @ d_input[lo:]])
        self._step(grad, np.concatenate([codes[:lo], np.arange(s.heads, s.heads + s.spellings)]), share)
        return states[-1]

    def _step(self, grad: Model, rows: np.ndarray, share: np.float32) -> None:
        """Gradients of some rows only: of ``rows`` for x, of those they come with for leaves."""
        some = {k: g if isinstance(g, tuple) else (rows if k == "x" else None, g) for k, g in grad.items()}
        norm = math.sqrt(sum(float(np.vdot(g, g)) for _, g in some.values())) * float(share)
        share = share * np.float32(min(1.0, CLIP / max(norm, 1e-9)))
        for k, (rows, g) in some.items():
            g = g * share
            move = g * g
            if rows is not None:
                move += self.squares[k].take(rows, axis=0)
                self.squares[k][rows] = move
            else:
                move += self.squares[k]
                self.squares[k][:] = move
            np.sqrt(move, out=move)
            g *= np.float32(RATE)
            g /= move
            if rows is not None:
                self.m[k][rows] = np.subtract(self.m[k].take(rows, axis=0), g, out=g)
            else:
                self.m[k] -= g
