"""Eigenvectors of a symmetric matrix by spectral divide and conquer on polar factors.

The polar factor of A - sI has eigenvalue 1 where those of A lie above s and -1
where they lie below, so (U + I) / 2 projects onto the upper ones. Its range and
the rest are invariant subspaces; each is split again until it has one dimension
or all its eigenvalues are equal to rounding. Polar factors come from QDWH:
dynamically weighted Halley steps, each one QR decomposition.

The matrices have the dimension of the vectors, which does not grow with their
number.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps


def _smallest(x: np.ndarray) -> float:
    """A lower bound of the singular values, rounding if ``x`` is singular."""
    try:
        return float(np.clip(0.9 / np.linalg.norm(np.linalg.inv(x)), EPS, 0.5))
    except np.linalg.LinAlgError:
        return EPS


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, which is symmetric too."""
    n = len(a)
    eye = np.eye(n)
    x = a / np.linalg.norm(a)
    least = _smallest(x)
    for _ in range(30):
        d = np.cbrt(4 * (1 - least**2) / least**4)
        root = np.sqrt(1 + d)
        alpha = root + np.sqrt(8 - 4 * d + 8 * (2 - least**2) / (least**2 * root)) / 2
        beta = (alpha - 1) ** 2 / 4
        gamma = alpha + beta - 1
        q, _ = np.linalg.qr(np.concatenate((np.sqrt(gamma) * x, eye)))
        step = beta / gamma * x + (alpha - beta / gamma) / np.sqrt(gamma) * (q[:n] @ q[n:].T)
        step = (step + step.T) / 2
        change = np.linalg.norm(step - x)
        x = step
        least = min(least * (alpha + beta * least**2) / (1 + gamma * least**2), 1 - EPS)
        if change < 1e-10 * np.sqrt(n):
            break
    # A Newton-Schulz step takes away what rounding left.
    return x @ (3 * eye - x @ x) / 2


def _ranges(projector: np.ndarray, rank: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the range of a projector and of its complement."""
    n = len(projector)
    rest = np.eye(n) - projector
    upper = np.linalg.qr(projector @ rng.standard_normal((n, rank)))[0]
    lower = np.linalg.qr(rest @ rng.standard_normal((n, n - rank)))[0]
    for _ in range(2):
        upper = np.linalg.qr(projector @ upper)[0]
        lower = np.linalg.qr(rest @ lower)[0]
    both = np.linalg.qr(np.concatenate((upper, lower), axis=1))[0]
    return both[:, :rank], both[:, rank:]


def _shifts(a: np.ndarray) -> list[float]:
    """Where to split: eigenvalues lie on both sides of each of these."""
    diagonal = np.sort(np.diag(a))
    n = len(diagonal)
    found = [float(np.median(diagonal)), float(diagonal.mean())]
    found += [float(diagonal[i : i + 2].mean()) for i in np.argsort(-np.diff(diagonal))[:8]]
    # Rows with large entries beside the diagonal need a shift off the diagonal's values.
    spread = np.linalg.norm(a - np.diag(np.diag(a))) / np.sqrt(n)
    return found + [found[1] + f * spread for f in (0.31, -0.37, 0.73, -0.79, 0.11, -0.13)]


def _split(a: np.ndarray, scale: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of two invariant subspaces of ``a``, the upper one first."""
    n = len(a)
    best, error = None, np.inf
    for shift in _shifts(a):
        moved = a - shift * np.eye(n)
        if not np.linalg.norm(moved):
            continue
        projector = (polar_factor(moved) + np.eye(n)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < n:
            continue
        upper, lower = _ranges(projector, rank, rng)
        left = np.linalg.norm(lower.T @ a @ upper)
        if left < error:
            best, error = (upper, lower), left
        # Small beside the whole matrix: both are invariant to rounding.
        if error <= 4 * n * EPS * scale:
            break
    return best


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors as columns."""
    a = (a + a.T) / 2
    rng = np.random.default_rng(20240229)
    scale = np.linalg.norm(a)
    vectors, todo = [], [np.eye(len(a))]
    while todo:
        basis = todo.pop()
        own = basis.T @ a @ basis
        own = (own + own.T) / 2
        n = len(own)
        level = np.trace(own) / n
        parts = None
        if n > 1 and np.linalg.norm(own - level * np.eye(n)) > n * EPS * scale:
            parts = _split(own, scale, rng)
        if parts is None:
            vectors.append(basis)
        else:
            todo += [basis @ parts[1], basis @ parts[0]]
    # Orthonormal to rounding after all the products; columns keep their order.
    v, r = np.linalg.qr(np.concatenate(vectors, axis=1)) if vectors else (np.zeros((0, 0)), np.zeros((0, 0)))
    v = v * np.where(np.diag(r) < 0, -1.0, 1.0)
    values = np.einsum("ij,ij->j", v, a @ v)
    order = np.argsort(-values, kind="stable")
    return values[order], v[:, order]
