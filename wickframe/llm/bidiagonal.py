"""Singular values and right singular vectors of a triangle: Householder, dqds, twisted factorisations."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
# Eigenvalues closer than this, in parts of the largest of them, share one search for their vectors.
CLOSE = 1e-5


def bidiagonalised(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(diagonal, above, v)`` so that ``matrix = u @ B @ v.T`` with B upper bidiagonal and ``v`` orthogonal."""
    work = np.array(matrix, np.float64)
    size = len(work)
    v = np.eye(size)

    def mirror(column: np.ndarray) -> np.ndarray | None:
        length = np.linalg.norm(column)
        if length == 0:
            return None
        normal = column.copy()
        normal[0] += np.copysign(length, column[0])
        return normal / np.linalg.norm(normal)

    for k in range(size):
        normal = mirror(work[k:, k])
        if normal is not None:
            work[k:, k:] -= 2 * np.outer(normal, normal @ work[k:, k:])
        if k < size - 2:
            normal = mirror(work[k, k + 1 :])
            if normal is not None:
                work[k:, k + 1 :] -= 2 * np.outer(work[k:, k + 1 :] @ normal, normal)
                v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ normal, normal)
    return np.diag(work).copy(), np.diag(work, 1).copy(), v


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, int]:
    """One dqds pass: the new arrays, the smallest ``d``, and where ``d`` fell below zero (or -1)."""
    d = q[0] - shift
    lowest = d
    new_q, new_e = [], []
    if d < 0:
        return q, e, d, 0
    for i, above in enumerate(e):
        pivot = d + above
        ratio = q[i + 1] / pivot
        new_q.append(pivot)
        new_e.append(above * ratio)
        d = d * ratio - shift
        if not d >= 0:
            return q, e, d, i + 1
        lowest = min(lowest, d)
    new_q.append(d)
    return new_q, new_e, lowest, -1


def qd_eigenvalues(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Eigenvalues of ``B.T @ B``, falling, from the squares ``q`` and ``e`` of B's diagonal and what stands above it.

    dqds with Rutishauser's shifts: the smallest ``d`` of the last pass is tried; where only the last ``d`` of
    a pass falls below zero, the shift plus that ``d`` is a lower bound that comes close; else it is cut.
    """
    found: list[float] = []
    tiny = np.finfo(np.float64).tiny
    blocks = [([float(x) + tiny for x in q], [float(x) for x in e], 0.0)]
    while blocks:
        q, e, shifted = blocks.pop()
        shift = 0.0
        for _ in range(60 * len(q) + 60):
            if len(q) == 1:
                break
            small = 1e-4 * EPS * EPS
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= small * (shifted + min(q[i], q[i + 1]))), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], shifted))
                q, e, shift = q[cut + 1 :], e[cut + 1 :], 0.0
                continue
            if q[0] * 1.5 < q[-1]:
                q, e = q[::-1], e[::-1]
            for attempt in range(5):
                new_q, new_e, lowest, failed = _transform(q, e, shift)
                if failed < 0:
                    break
                late = failed == len(q) - 1 and shift + lowest > 0 and attempt < 3
                shift = shift + lowest if late else shift / 4 if attempt < 3 else 0.0
            q, e, shifted = new_q, [max(x, tiny) for x in new_e], shifted + shift
            # A pivot of zero would be divided by; the smallest number there is stands for it.
            q = [max(x, tiny) for x in q]
            shift = lowest
        else:
            raise ArithmeticError("dqds did not converge")
        found.append(shifted + q[0])
    return np.sort(np.array(found))[::-1]


class Twisted:
    """Twisted factorisation of ``B.T @ B - shift``, at the place that shows its smallest pivot."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, shift: float):
        squares, links = diagonal * diagonal, above / diagonal[:-1]  # B.T @ B = L D L.T
        size, floor = len(diagonal), EPS * EPS * max(shift, float(squares.max()))
        down, up = np.empty(size), np.empty(size)
        self._lower, self._upper = np.empty(size - 1), np.empty(size - 1)
        held = np.empty(size)
        s = -shift
        for i in range(size - 1):  # stationary, from the top
            held[i] = s
            pivot = s + squares[i]
            pivot = pivot if abs(pivot) > floor else -floor
            down[i] = pivot
            self._lower[i] = diagonal[i] * above[i] / pivot
            s = self._lower[i] * links[i] * s - shift
        held[-1], down[-1] = s, s + squares[-1]
        p = squares[-1] - shift
        up[-1] = p
        seen = np.empty(size)
        seen[-1] = p
        for i in range(size - 2, -1, -1):  # progressive, from the bottom
            pivot = above[i] * above[i] + p
            pivot = pivot if abs(pivot) > floor else -floor
            up[i + 1] = pivot
            self._upper[i] = diagonal[i] * above[i] / pivot
            p = p * (squares[i] / pivot) - shift
            seen[i] = p
        gamma = held + seen + shift
        self._at = int(np.argmin(np.abs(gamma)))
        self._pivots = np.concatenate([down[: self._at], [gamma[self._at]], up[self._at + 1 :]])
        self._pivots[self._at] = self._pivots[self._at] if abs(self._pivots[self._at]) > floor else floor

    def vector(self) -> np.ndarray:
        """The vector that the factors send to a multiple of one unit vector: the eigenvector at a good shift."""
        z = np.zeros(len(self._pivots))
        z[self._at] = 1
        for i in range(self._at - 1, -1, -1):
            z[i] = -self._lower[i] * z[i + 1]
        for i in range(self._at, len(z) - 1):
            z[i + 1] = -self._upper[i] * z[i]
        return z / np.linalg.norm(z)

    def solve(self, right: np.ndarray) -> np.ndarray:
        """``x`` with ``(B.T @ B - shift) @ x = right``, for the columns of ``right``."""
        x = np.array(right, np.float64)
        for i in range(self._at):
            x[i + 1] -= self._lower[i] * x[i]
        for i in range(len(x) - 2, self._at - 1, -1):
            x[i] -= self._upper[i] * x[i + 1]
        x /= self._pivots[:, None]
        for i in range(self._at - 1, -1, -1):
            x[i] -= self._lower[i] * x[i + 1]
        for i in range(self._at, len(x) - 1):
            x[i + 1] -= self._upper[i] * x[i]
        return x


def _block_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of ``B.T @ B`` for its falling eigenvalues ``values``, as columns.

    Lone eigenvalues take the vector of their twisted factorisation. Close ones share a space, found by
    inverse iteration with the factors and orthogonal columns, and turned to the eigenvectors in it.
    """
    if len(diagonal) == 1:
        return np.ones((1, 1))
    columns = np.zeros((len(diagonal), len(values)))
    start = 0
    draw = np.random.default_rng(0)
    while start < len(values):
        end = start + 1
        while end < len(values) and values[end - 1] - values[end] <= CLOSE * values[start]:
            end += 1
        if end - start == 1:
            columns[:, start] = Twisted(diagonal, above, values[start]).vector()
        else:
            space = np.linalg.qr(draw.standard_normal((len(diagonal), end - start)))[0]
            for _ in range(4):
                space = np.column_stack(
                    [Twisted(diagonal, above, values[start + j]).solve(space[:, j : j + 1])[:, 0] for j in range(end - start)]
                )
                space -= columns[:, :start] @ (columns[:, :start].T @ space)
                space = np.linalg.qr(space / np.linalg.norm(space, axis=0))[0]
            image = diagonal[:, None] * space
            image[:-1] += above[:, None] * space[1:]
            turned = np.linalg.eigh(image.T @ image)[1][:, ::-1]
            columns[:, start:end] = space @ turned
        start = end
    return columns


def right_singular(triangle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values, falling, and the right singular vectors of those above zero, as columns.

    Squares up to ``(size * eps)**2`` of the largest are noise of the reduction and come out as zero.
    """
    size = len(triangle)
    scale = float(np.abs(triangle).max(initial=0.0))
    if scale == 0:
        return np.zeros(size), np.zeros((size, 0))
    diagonal, above, v = bidiagonalised(triangle / scale)
    largest = float(np.sqrt((diagonal**2).sum() + (above**2).sum()))
    # Beyond the accuracy of the reduction zeros are as good as these, and nothing divides by them.
    diagonal = np.where(np.abs(diagonal) < 1e-3 * EPS * largest, 1e-3 * EPS * largest, diagonal)
    above = np.where(np.abs(above) < 1e-3 * EPS * largest, 0.0, above)
    edges = [0, *(np.nonzero(above == 0)[0] + 1).tolist(), size]
    values, vectors = [], np.zeros((size, size))
    for low, high in zip(edges, edges[1:]):
        some = qd_eigenvalues(diagonal[low:high] ** 2, above[low : high - 1] ** 2)
        vectors[low:high, low:high] = _block_vectors(diagonal[low:high], above[low : high - 1], some)
        values.extend(some.tolist())
    order = np.argsort(values, kind="stable")[::-1]
    squares = np.array(values)[order]
    squares[squares <= (size * EPS) ** 2 * squares[0]] = 0
    return squares * scale * scale, (v @ vectors)[:, order[squares > 0]]
