"""Small dense solves for models of a few hundred coefficients, kept free of multi-threaded LAPACK on the driver."""

from __future__ import annotations

import numpy as np


def inverse(a: np.ndarray) -> np.ndarray:
    """Inverse of a regular square matrix by Gauss-Jordan elimination with partial pivoting."""
    n = len(a)
    m = np.hstack([a.astype(float), np.eye(n)])
    for i in range(n):
        p = i + int(np.abs(m[i:, i]).argmax())
        if m[p, i] == 0:
            raise ValueError("the matrix is singular")
        if p != i:
            m[[i, p]] = m[[p, i]]
        m[i] /= m[i, i]
        f = m[:, i].copy()
        f[i] = 0
        m -= np.outer(f, m[i])
    return m[:, n:]


def cholesky(a: np.ndarray) -> np.ndarray:
    """Lower triangle L of a positive definite matrix, a = L L'."""
    n = len(a)
    low = np.zeros((n, n))
    for j in range(n):
        v = a[j:, j] - low[j:, :j] @ low[j, :j]
        low[j:, j] = v / np.sqrt(max(v[0], 1e-12))
    return low
