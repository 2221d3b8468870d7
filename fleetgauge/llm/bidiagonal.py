"""Singular values and right singular vectors of a triangular factor, without forming products.

Householder reflections make the factor bidiagonal; the differential quotient-difference algorithm
(Fernando & Parlett, 1994) finds its singular values to high relative accuracy; twisted
factorisations (Parlett & Dhillon, 1997) give the vectors.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps


def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and W with r = U B W^T; U isn't kept."""
    a = np.array(r, float)
    n = len(a)
    w = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        """Unit v with (I - 2 v v^T) x along the first axis, None if x lies there already."""
        v = x / (np.abs(x).max() or 1.0)
        if not np.any(v[1:]):
            return None
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        return v / np.linalg.norm(v)

    for k in range(n):
        v = reflector(a[k:, k].copy())
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k + 2 < n:
            v = reflector(a[k, k + 1 :].copy())
            if v is not None:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
                w[:, k + 1 :] -= 2 * np.outer(w[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def _step(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float] | None:
    """One shifted transform of qd arrays, or None if the shift was too large."""
    n = len(q)
    new_q, new_e = np.empty(n), np.empty(n - 1)
    d = q[0] - shift
    for i in range(n - 1):
        if d < 0:
            return None
        new_q[i] = d + e[i]
        if new_q[i] == 0:  # a zero value: what follows starts anew
            new_e[i], d = 0.0, q[i + 1] - shift
            continue
        ratio = q[i + 1] / new_q[i]
        new_e[i] = e[i] * ratio
        d = d * ratio - shift
    if d < 0:
        return None
    new_q[-1] = d
    return new_q, new_e, d


def _smallest_bound(q: np.ndarray, e: np.ndarray) -> float:
    """A shift near the smallest value: that of the last two rows."""
    a, b, c = q[-2] + (e[-3] if len(e) > 2 else 0.0), e[-1], q[-1]
    total, product = a + b + c, a * c
    root = np.sqrt(max(total * total / 4 - product, 0.0))
    return product / (total / 2 + root) if total > 0 else 0.0


def squared_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix, falling, by dqds with deflation."""
    out: list[float] = []
    todo = [(np.asarray(diagonal, float) ** 2, np.asarray(above, float) ** 2, 0.0)]
    while todo:
        q, e, moved = todo.pop()
        failed = 0
        while len(q):
            if len(q) == 1:
                out.append(q[0] + moved)
                break
            if e[-1] <= _EPS**2 * (q[-1] + moved) or (q[-1] == 0 and e[-1] == 0):
                out.append(q[-1] + moved)
                q, e = q[:-1], e[:-1]
                continue
            gone = np.flatnonzero(e <= _EPS**2 * (q[1:] + moved))
            if len(gone):  # independent parts
                at = int(gone[-1]) + 1
                todo.append((q[:at], e[: at - 1], moved))
                q, e = q[at:], e[at:]
                continue
            if q[0] < q[-1] / 2.25:  # graded the other way round: the same values, faster
                q, e = _turned(q, e)
            shift = _smallest_bound(q, e) * (1 - 4 * _EPS) * 0.25**failed if failed < 6 else 0.0
            made = _step(q, e, shift)
            if made is None:
                failed += 1
                continue
            failed = 0
            moved += shift
            q, e, _ = made
    return np.sort(np.array(out))[::-1]


def _turned(q: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The qd arrays of the flipped matrix: entries of the bidiagonal in reverse order."""
    return q[::-1].copy(), e[::-1].copy()


def _twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """Eigenvector of B^T B for an eigenvalue, from the twisted factorisation with least pivot."""
    n = len(diagonal)
    tiny = np.finfo(float).tiny
    # B^T B = L D L^T with D = diagonal^2, L below the diagonal = above / diagonal
    q = np.where(diagonal == 0, tiny, diagonal**2)
    low = above / np.where(diagonal[:-1] == 0, np.sqrt(tiny), diagonal[:-1])
    s = np.empty(n)  # stationary: L D L^T - value = L+ D+ L+^T
    s[0] = -value
    plus, l_plus = np.empty(n), np.empty(n - 1)
    for i in range(n - 1):
        plus[i] = s[i] + q[i]
        plus[i] = plus[i] if plus[i] != 0 else -_EPS * abs(value) - tiny
        l_plus[i] = q[i] * low[i] / plus[i]
        s[i + 1] = l_plus[i] * low[i] * s[i] - value
    plus[-1] = s[-1] + q[-1]
    p = np.empty(n)  # progressive: = U- D- U-^T
    p[-1] = q[-1] - value
    u_minus = np.empty(n - 1)
    for i in range(n - 2, -1, -1):
        minus = q[i] * low[i] ** 2 + p[i + 1]
        minus = minus if minus != 0 else -_EPS * abs(value) - tiny
        ratio = q[i] / minus
        u_minus[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - value
    twist = s + p + value
    r = int(np.argmin(np.abs(np.where(np.isfinite(twist), twist, np.inf))))
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -l_plus[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -u_minus[i] * z[i]
    return z


def _parts(above: np.ndarray, scale: float) -> list[tuple[int, int]]:
    """Index ranges that a negligible superdiagonal separates."""
    cuts = np.flatnonzero(np.abs(above) <= _EPS * scale) + 1
    edges = [0, *cuts.tolist(), len(above) + 1]
    return list(zip(edges, edges[1:]))


def right_vectors(r: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The `top` largest squared singular values of square `r`, falling, and their right singular
    vectors as columns: unit, orthogonal, the entry of largest size positive. Values that rounding
    can't tell from zero (singular values up to n eps times the largest) are left out.

    Values that lie closer than a thousandth share a cluster; their vectors are made orthogonal
    and, by products with the factor itself on the cluster's span, each its own."""
    diagonal, above, w = bidiagonalised(r)
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if scale == 0:
        return np.zeros(0), np.zeros((len(r), 0))
    found: list[tuple[float, np.ndarray]] = []
    for start, end in _parts(above, scale):
        d, e = diagonal[start:end] / scale, above[start : end - 1] / scale
        values = squared_values(d, e)
        for value in values[:top]:
            z = np.zeros(len(r))
            z[start:end] = _twisted(d, e, value) if end - start > 1 else 1.0
            found.append((value, z / np.linalg.norm(z)))
    found.sort(key=lambda f: -f[0])
    found = [f for f in found if f[0] > (len(r) * _EPS) ** 2 * found[0][0]]
    values = np.array([f[0] for f in found])
    last = min(top, len(values))
    while last < len(values) and values[last - 1] - values[last] <= 1e-3 * values[last - 1]:
        last += 1  # the cluster that `top` cuts is solved whole
    vectors = np.stack([f[1] for f in found[:last]], axis=1)
    b = np.diag(diagonal / scale) + np.diag(above / scale, 1)
    at = 0
    while at < last:
        end = at + 1
        while end < last and values[end - 1] - values[end] <= 1e-3 * values[end - 1]:
            end += 1
        if end - at > 1:
            vectors[:, at:end] = _separated(b, vectors[:, :at], vectors[:, at:end], values[at:end])
        at = end
    vectors = w @ vectors
    vectors *= np.sign(vectors[np.abs(vectors).argmax(0), np.arange(last)])
    return values[:top] * scale**2, vectors[:, :top]


def _separated(b: np.ndarray, before: np.ndarray, near: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal vectors of a cluster: twice inverse iteration from well-spread starts, away from
    the vectors before, then rotation within the span so that B maps them to orthogonal images."""
    n, k = near.shape
    draw = np.random.default_rng(0)
    start, _ = np.linalg.qr(near + 1e-8 * draw.standard_normal((n, k)))
    gram = b.T @ b
    shifted = gram - values.mean() * (1 + 64 * _EPS) * np.eye(n)
    for _ in range(3):
        start = np.linalg.solve(shifted, start)
        start -= before @ (before.T @ start)
        start, _ = np.linalg.qr(start)
    _, _, turn = np.linalg.svd(b @ start, full_matrices=False)  # as small as the cluster
    return start @ turn.T
