"""Gradients of array expressions, recorded as they are computed: the few operations that the networks need."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np


class Var:
    """An array, and for each array it was computed from how its gradient passes on."""

    def __init__(self, value: np.ndarray, parents: Sequence[tuple[Var, Callable]] = ()):
        self.value, self.parents, self.grad = value, parents, None

    def __add__(self, other):
        other = other if isinstance(other, Var) else Var(np.asarray(other))
        return Var(self.value + other.value, [(self, lambda g: _fit(g, self.value)), (other, lambda g: _fit(g, other.value))])

    def __mul__(self, other):
        other = other if isinstance(other, Var) else Var(np.asarray(other))
        return Var(self.value * other.value, [(self, lambda g: _fit(g * other.value, self.value)), (other, lambda g: _fit(g * self.value, other.value))])

    def __matmul__(self, other: Var):
        """Rows times a matrix; leading axes of the left side are kept."""
        a, b = self.value, other.value
        flat = lambda x: x.reshape(-1, x.shape[-1])
        return Var(a @ b, [(self, lambda g: g @ b.T), (other, lambda g: flat(a).T @ flat(g))])

    def __getitem__(self, at):
        def back(g):
            out = np.zeros_like(self.value)
            out[at] = g
            return out

        return Var(self.value[at], [(self, back)])

    def gradient(self) -> None:
        """Set `grad` of everything this was computed from, for a gradient of one here."""
        order, seen, stack = [], set(), [(self, False)]
        while stack:
            node, done = stack.pop()
            if done:
                order.append(node)
            elif id(node) not in seen:
                seen.add(id(node))
                stack.append((node, True))
                stack.extend((p, False) for p, _ in node.parents)
        self.grad = np.ones_like(self.value)
        for node in reversed(order):
            for parent, back in node.parents:
                g = back(node.grad)
                parent.grad = g if parent.grad is None else parent.grad + g


def _fit(g: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Sum a gradient over the axes along which its array was repeated."""
    while g.ndim > like.ndim:
        g = g.sum(axis=0)
    for axis, size in enumerate(like.shape):
        if size == 1 and g.shape[axis] != 1:
            g = g.sum(axis=axis, keepdims=True)
    return g


def tanh(x: Var) -> Var:
    y = np.tanh(x.value)
    return Var(y, [(x, lambda g: g * (1 - y * y))])


def sigmoid(x: Var) -> Var:
    y = 1 / (1 + np.exp(-np.clip(x.value, -60, 60)))
    return Var(y, [(x, lambda g: g * y * (1 - y))])


def exp(x: Var) -> Var:
    y = np.exp(x.value)
    return Var(y, [(x, lambda g: g * y)])


def relu(x: Var) -> Var:
    on = x.value > 0
    return Var(x.value * on, [(x, lambda g: g * on)])


def mean_square(x: Var, weights: np.ndarray) -> Var:
    """The weighted sum of squares (not divided)."""
    return Var(np.sum(weights * x.value * x.value), [(x, lambda g: 2 * g * weights * x.value)])


def join(parts: Sequence[Var], axis: int = -1) -> Var:
    cuts = np.cumsum([0, *(p.value.shape[axis] for p in parts)])

    def back(i):
        return lambda g: np.take(g, np.arange(cuts[i], cuts[i + 1]), axis=axis)

    return Var(np.concatenate([p.value for p in parts], axis=axis), [(p, back(i)) for i, p in enumerate(parts)])


def stack(parts: Sequence[Var], axis: int) -> Var:
    return Var(np.stack([p.value for p in parts], axis=axis), [(p, lambda g, i=i: np.take(g, i, axis=axis)) for i, p in enumerate(parts)])


def delay(x: Var, steps: int, axis: int = 0) -> Var:
    """Moved `steps` places along an axis (back if negative); zeros come in."""
    def moved(a, n):
        out = np.zeros_like(a)
        size = a.shape[axis]
        if abs(n) < size:
            cut = lambda lo, hi: tuple(slice(lo, hi) if i == axis % a.ndim else slice(None) for i in range(a.ndim))
            out[cut(max(n, 0), size + min(n, 0))] = a[cut(max(-n, 0), size - max(n, 0))]
        return out

    return Var(moved(x.value, steps), [(x, lambda g: moved(g, -steps))])


def interleave(even: Var, odd: Var, axis: int) -> Var:
    """Even and odd places of an axis put together again."""
    size = even.value.shape[axis] + odd.value.shape[axis]
    ndim = even.value.ndim
    at = lambda first: tuple(slice(first, None, 2) if i == axis % ndim else slice(None) for i in range(ndim))
    out = np.empty([size if i == axis % ndim else n for i, n in enumerate(even.value.shape)])
    out[at(0)], out[at(1)] = even.value, odd.value
    return Var(out, [(even, lambda g: g[at(0)]), (odd, lambda g: g[at(1)])])
