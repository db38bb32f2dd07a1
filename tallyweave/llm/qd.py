"""Singular values and right singular vectors of a small square matrix.

Householder reflections make it bidiagonal; differential quotient-difference
sweeps with shifts (dqds) find the squares of the singular values, each to high
relative accuracy; twisted factorisations at these squares give the vectors.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)

#: Squares whose relative distance is below this are one cluster, whose vectors are found together.
CLUSTER = 1e-5


def _reflector(x: np.ndarray) -> np.ndarray:
    """The unit vector whose reflection takes x to a multiple of the first axis; zero if x is one already."""
    h = x.copy()
    if np.any(h[1:]):
        h[0] += np.copysign(np.linalg.norm(h), h[0])
        return h / np.linalg.norm(h)
    return np.zeros_like(h)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal, and v of r = u b v'."""
    m = np.array(r, np.float64)
    n = len(m)
    v = np.eye(n)
    for k in range(n):
        h = _reflector(m[k:, k])
        m[k:, k:] -= np.outer(2 * h, h @ m[k:, k:])
        if k < n - 2:
            h = _reflector(m[k, k + 1 :])
            m[k:, k + 1 :] -= np.outer(m[k:, k + 1 :] @ h, 2 * h)
            v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ h, 2 * h)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One dqds transform, which takes shift off every square, and its d; a negative d says that the shift was too large."""
    d, qs, es, ds = q[0] - shift, [], [], []
    for i, x in enumerate(e):
        ds.append(d)
        if d < 0:
            break
        qs.append(d + x)
        t = q[i + 1] / qs[-1] if qs[-1] else 0.0
        es.append(x * t)
        d = d * t - shift
    ds.append(d)
    qs.append(d)
    return qs, es, ds


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, largest first.

    A sweep without shift gives d, of which 1 / sum(1 / d) is Newton's lower
    bound of the least square; the next sweep is shifted by it.
    """
    top = max(float(np.max(np.abs(a), initial=0.0)), float(np.max(np.abs(b), initial=0.0)))
    if not top:
        return np.zeros(len(a))
    scaled = np.maximum(np.abs(a) / top, 1e-30)  # an exact zero would stop a sweep; so small a square counts as none
    todo, found = [((scaled**2).tolist(), ((b / top) ** 2).tolist(), 0.0)], []
    while todo:
        q, e, total = todo.pop()
        for _ in range(1000 * len(q)):
            if len(q) == 1:
                break
            if q[0] < q[-1]:  # the least square is found at the end
                q.reverse()
                e.reverse()
            q, e, d = _sweep(q, e, 0.0)
            low = 1 / sum(1 / x if x else float("inf") for x in d)
            least = EPS * EPS * (total + low)
            if e[-1] <= least:
                found.append(total + q.pop())
                e.pop()
                continue
            cut = next((i for i, x in enumerate(e) if x <= least), None)
            if cut is not None:
                todo.append((q[cut + 1 :], e[cut + 1 :], total))
                q, e = q[: cut + 1], e[:cut]
                continue
            shift = low * (1 - 8 * EPS)
            while shift > EPS * total:
                moved = _sweep(q, e, shift)
                if min(moved[2]) >= 0:
                    q, e, total = moved[0], moved[1], total + shift
                    break
                shift /= 2
        else:
            raise ArithmeticError("no convergence")
        found.append(total + q[0])
    return np.sort(np.array(found))[::-1] * top**2


def _twisted(d: np.ndarray, low: np.ndarray, square: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multipliers of the factorisations of L D L' - square from above and from below, and gamma of each twist between them."""
    n = len(d)
    ds, ls = d.tolist(), low.tolist()
    s, p, up, down = [-square] * n, [0.0] * n, [0.0] * n, [0.0] * n
    for i in range(n - 1):
        up[i] = ds[i] * ls[i] / (s[i] + ds[i] or EPS * square)
        s[i + 1] = up[i] * ls[i] * s[i] - square
    p[-1] = ds[-1] - square
    for i in reversed(range(n - 1)):
        t = ds[i] / (ds[i] * ls[i] ** 2 + p[i + 1] or EPS * square)
        down[i] = ls[i] * t
        p[i] = p[i + 1] * t - square
    return np.array(up), np.array(down), np.array(s) + np.array(p) + square


def _vector(up: np.ndarray, down: np.ndarray, twist: int) -> np.ndarray:
    z = [0.0] * len(up)
    z[twist] = 1.0
    for i in reversed(range(twist)):
        z[i] = -up[i] * z[i + 1]
    for i in range(twist, len(up) - 1):
        z[i + 1] = -down[i] * z[i]
    return np.array(z)


def _rotated(z: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The columns of z turned until their images under b are orthogonal (one-sided Jacobi), longest image first."""
    image = b @ z
    for _ in range(30):
        most = 0.0
        for i in range(z.shape[1]):
            for j in range(i + 1, z.shape[1]):
                x, y, c = image[:, i] @ image[:, i], image[:, j] @ image[:, j], image[:, i] @ image[:, j]
                if abs(c) <= 2 * EPS * np.sqrt(x * y):
                    continue
                most = max(most, abs(c) / np.sqrt(x * y))
                angle = 0.5 * np.arctan2(2 * c, x - y)
                turn = np.array([[np.cos(angle), -np.sin(angle)], [np.sin(angle), np.cos(angle)]])
                image[:, [i, j]], z[:, [i, j]] = image[:, [i, j]] @ turn, z[:, [i, j]] @ turn
        if most <= 4 * EPS:
            break
    return z[:, np.argsort(-np.linalg.norm(image, axis=0), kind="stable")]


def right_vectors(a: np.ndarray, b: np.ndarray, found: np.ndarray, k: int) -> np.ndarray:
    """Right singular vectors, as columns, of the k largest squares found.

    The squares are those of b'b = L D L'. Where a vector's square stands
    alone, the twist of the least gamma gives it, and its Rayleigh quotient the
    next square, until that stays. A cluster takes one vector from each of
    several twists, orthogonal to those before.
    """
    n, k = len(a), min(k, len(a))
    top = float(np.sqrt(found[0]))
    a = np.where(np.abs(a) > 1e-30 * top, a, 1e-30 * top) / top
    b = b / top
    d, low, goal = a**2, b / a[:-1], found / top**2
    matrix = np.diag(a) + np.diag(b, 1)
    out, first = [], 0
    while first < k:
        last = first + 1
        while last < len(goal) and goal[last - 1] - goal[last] <= CLUSTER * goal[last - 1]:
            last += 1
        if last == first + 1:
            square = float(goal[first])
            for _ in range(4):
                up, down, gamma = _twisted(d, low, square)
                twist = int(np.nanargmin(np.abs(gamma)))
                z = _vector(up, down, twist)
                step = float(gamma[twist] / (z @ z))
                if not abs(step) > 4 * EPS * square:
                    break
                square += step
            out.append(z / np.linalg.norm(z))
        else:
            basis: list[np.ndarray] = []
            for square in goal[first:last]:
                up, down, gamma = _twisted(d, low, float(square))
                best, most = np.zeros(n), 0.0
                for twist in np.argsort(np.abs(gamma), kind="stable"):
                    z = _vector(up, down, int(twist))
                    z /= np.linalg.norm(z)
                    for _ in range(2):
                        for w in basis:
                            z = z - (w @ z) * w
                    left = float(np.linalg.norm(z))
                    if left > most:
                        best, most = z / left, left
                    if most > 0.1:
                        break
                basis.append(best)
            out.extend(_rotated(np.array(basis).T, matrix).T)
        first = last
    return np.array(out[:k]).reshape(-1, n).T
