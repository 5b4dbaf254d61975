"""Leading eigenvalues of a symmetric matrix by slicing its spectrum.

The inertia of ``A - s I``, read off a pivoted LDL^T factorisation, tells how many
eigenvalues lie above ``s``.  Bisection on these counts isolates each leading
eigenvalue; Rayleigh quotient iteration inside the interval then converges
cubically, and two more counts, on both sides of the result, certify its number.

A matrix here is a covariance of ``d`` dimensions: its size depends on the length
of the vectors, never on how many there are.
"""

from __future__ import annotations

import numpy as np

# Bound of the pivot choice that keeps growth least (Bunch and Parlett).
_ALPHA = (1 + 17**0.5) / 8
_EPS = np.finfo(np.float64).eps
_ITERATIONS = 40


def _swap(a: np.ndarray, p: int, q: int) -> None:
    if p != q:
        a[[p, q]] = a[[q, p]]
        a[:, [p, q]] = a[:, [q, p]]


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues above ``shift``, from the signs of D in LDL^T of ``matrix - shift I``."""
    a = np.array(matrix, dtype=np.float64)
    a[np.diag_indices_from(a)] -= shift
    n, above = len(a), 0
    while n:
        part = a[:n, :n]
        diagonal = np.abs(part.diagonal())
        p = int(diagonal.argmax())
        off = np.abs(part)
        off[np.diag_indices(n)] = 0
        r, s = divmod(int(off.argmax()), n)
        if diagonal[p] >= _ALPHA * off[r, s]:
            _swap(part, p, n - 1)
            pivot = part[n - 1, n - 1]
            if pivot == 0:
                break  # what is left is zero
            above += pivot > 0
            n -= 1
            column = part[:n, n].copy()
            part[:n, :n] -= np.outer(column, column / pivot)
        else:
            _swap(part, max(r, s), n - 1)
            _swap(part, min(r, s), n - 2)
            above += 1  # such a block has a negative determinant: one eigenvalue of each sign
            n -= 2
            columns = part[:n, n:].copy()
            part[:n, :n] -= columns @ np.linalg.solve(part[n:, n:], columns.T)
    return above


def _apart(vector: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    """Unit vector orthogonal to those found."""
    for _ in range(2):
        for other in found:
            vector = vector - other * (other @ vector)
    return vector / np.linalg.norm(vector)


def _solve(matrix: np.ndarray, shift: float, right: np.ndarray, tiny: float) -> np.ndarray:
    shifted = matrix - shift * np.eye(len(matrix))
    try:
        out = np.linalg.solve(shifted, right)
    except np.linalg.LinAlgError:
        out = np.linalg.solve(shifted - tiny * np.eye(len(matrix)), right)
    return out / np.abs(out).max()


def _iterate(matrix, low: float, high: float, found: list[np.ndarray], tiny: float, seed: int):
    """Rayleigh quotient iteration from the middle of an interval: ``(value, vector)`` or None."""
    vector = _apart(np.random.default_rng(seed).standard_normal(len(matrix)), found)
    value = (low + high) / 2
    for turn in range(_ITERATIONS):
        vector = _apart(_solve(matrix, value, vector, tiny), found)
        if turn >= 2:  # the first steps keep the shift, to turn to the interval's own vector
            value = float(vector @ matrix @ vector)
            if np.linalg.norm(matrix @ vector - value * vector) <= tiny:
                # One more step takes the vector's error below that of the value.
                vector = _apart(_solve(matrix, value, vector, tiny), found)
                value = float(vector @ matrix @ vector)
                return (value, vector) if low - tiny <= value <= high + tiny else None
    return None


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues, falling, and their unit vectors as columns.

    Of a repeated eigenvalue, any orthonormal vectors of its space.
    """
    d = len(matrix)
    norm = float(np.abs(matrix).sum(axis=1).max()) if d else 0.0
    most = min(most, d)
    if norm == 0:
        return np.zeros(most), np.eye(d)[:, :most]
    tiny = 4 * d * _EPS * norm
    # Counts at shifts tried so far, for all eigenvalues.
    counts = {-norm - 2 * tiny: d, norm + 2 * tiny: 0}
    values, vectors = [], []
    for j in range(1, most + 1):
        while True:
            low = max(s for s, c in counts.items() if c >= j)
            high = min(s for s, c in counts.items() if c < j)
            alone = counts[low] == j and counts[high] == j - 1
            if alone or high - low <= tiny:
                result = _iterate(matrix, low, high, vectors, tiny, j)
                if result is not None:
                    value, vector = result
                    # Certificate: the j-th eigenvalue lies within the error of the value.
                    if count_above(matrix, value - 2 * tiny) >= j > count_above(matrix, value + 2 * tiny):
                        break
                if high - low <= tiny:
                    raise ArithmeticError(f"no eigenvector for eigenvalue {j} in [{low}, {high}]")
            middle = (low + high) / 2
            counts[middle] = count_above(matrix, middle)
        values.append(value)
        vectors.append(vector)
    return np.asarray(values), np.column_stack(vectors)
