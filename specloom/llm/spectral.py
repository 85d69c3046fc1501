"""Eigenvectors of a symmetric matrix by QDWH spectral divide-and-conquer.

The polar factor of a shifted matrix is the sign of its spectrum: half of it plus the identity
projects on the invariant subspace above the shift. An orthonormal basis of that subspace and
of its complement splits the matrix in two independent smaller ones, down to single
components. The polar factor comes from dynamically weighted Halley iterations, each one QR
factorisation without an inverse, at most a handful from any conditioning.

The shift is the mean eigenvalue (trace over size), which lies strictly inside every spectrum
of more than one value, so each split is a real one. Parts below all wanted components are
not split further.
"""

from __future__ import annotations

import math

import numpy as np

EPS = np.finfo(float).eps


def polar_sign(a: np.ndarray, rounds: int = 40) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QR-based Halley iterations."""
    n = len(a)
    x = a / max(np.sqrt(np.abs(a).sum(0).max() * np.abs(a).sum(1).max()), np.finfo(float).tiny)  # at least the 2-norm
    try:
        low = 0.9 / (np.linalg.norm(np.linalg.inv(x), 1) * 1.0)
    except np.linalg.LinAlgError:
        low = EPS
    low = min(max(low, EPS), 1.0)
    for _ in range(rounds):
        square = low * low
        d = (4 * (1 - square) / square**2) ** (1 / 3)
        first = math.sqrt(1 + d)
        p = first + 0.5 * math.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * first), 0.0))
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        both, _ = np.linalg.qr(np.vstack([math.sqrt(r) * x, np.eye(n)]))
        nxt = (q / r) * x + (p - q / r) / math.sqrt(r) * (both[:n] @ both[n:].T)
        nxt = (nxt + nxt.T) / 2
        moved = np.linalg.norm(nxt - x)
        x, low = nxt, min(low * (p + q * square) / (1 + r * square), 1.0)
        if moved <= (10 * EPS) ** (1 / 3) * np.linalg.norm(x) and abs(1 - low) < 10 * EPS:
            break
    return x


def _split(a: np.ndarray, shift: float, noise: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift, or None where it is too near an eigenvalue."""
    n = len(a)
    projector = (polar_sign(a - shift * np.eye(n)) + np.eye(n)) / 2
    rank = round(float(np.trace(projector)))
    if not 0 < rank < n or np.linalg.norm(projector @ projector - projector) > 1e-8 * math.sqrt(n):
        return None
    basis, _ = np.linalg.qr(projector @ noise.standard_normal((n, rank)))
    best = None
    for _ in range(3):
        whole, _ = np.linalg.qr(projector @ basis, mode="complete")
        basis, rest = whole[:, :rank], whole[:, rank:]
        off = np.linalg.norm(rest.T @ a @ basis)
        if best is None or off < best[0]:
            best = (off, basis, rest)
    return None if best[0] > 1e-10 * np.linalg.norm(a) else best[1:]


def components(a: np.ndarray, wanted: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The largest `wanted` eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    size = len(a)
    wanted = size if wanted is None else min(wanted, size)
    scale = np.linalg.norm(a)
    noise = np.random.default_rng(11)
    found: list[np.ndarray] = []

    def divide(part: np.ndarray, basis: np.ndarray) -> None:
        """Components of a part of the spectrum, larger ones first, until enough are known."""
        n = len(part)
        if len(found) >= wanted:
            return
        middle = float(np.trace(part)) / n
        spread = np.linalg.norm(part - middle * np.eye(n))
        if n == 1 or spread <= 4 * EPS * scale:  # one eigenvalue: any basis will do
            found.extend(basis.T)
            return
        for step in (0.0, 0.01, -0.01, 0.05, -0.05, 0.2, -0.2, 0.4, -0.4):
            cut = _split(part, middle + step * spread / math.sqrt(n), noise)
            if cut is not None:
                break
        else:  # eigenvalues apart by rounding only
            found.extend(basis.T)
            return
        for side in cut:
            inner = side.T @ part @ side
            divide((inner + inner.T) / 2, basis @ side)

    divide((a + a.T) / 2, np.eye(size))
    vectors = np.array(found).reshape(-1, size).T
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], vectors[:, order]
