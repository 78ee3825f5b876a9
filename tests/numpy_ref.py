"""Independent NumPy reference implementations used by the tests."""

import math

import numpy as np


def best_first_tree(x, y, max_leaves=None, min_leaf=1, max_depth=None):
    """One-feature CART on the Gini criterion: best-first (max_leaves) or depth-first (max_depth)."""
    order = np.argsort(x, kind="stable")
    x, y = np.asarray(x, float)[order], np.asarray(y, int)[order]
    n = len(x)

    def best(a, b):
        xs, ys = x[a:b], y[a:b]
        nn = b - a
        G = ys.sum()
        B = nn - G
        if G == 0 or B == 0 or nn < 2 * min_leaf:
            return None
        cg = np.cumsum(ys)
        out = None
        for i in range(nn - 1):
            if xs[i] == xs[i + 1]:
                continue
            nl = i + 1
            gl = cg[i]
            bl, nr, gr = nl - gl, nn - nl, G - gl
            br = nr - gr
            if nl < min_leaf or nr < min_leaf:
                continue
            g = (gl * gl + bl * bl) / nl + (gr * gr + br * br) / nr - (G * G + B * B) / nn
            if out is None or g > out[0] + 1e-12:
                out = (g, a + i + 1, xs[i] / 2 + xs[i + 1] / 2)
        return out

    cuts = []
    if max_depth is None:
        leaves = [(0, n)]
        while len(leaves) < max_leaves:
            cands = [(best(a, b), (a, b)) for a, b in leaves]
            cands = [(c, l) for c, l in cands if c]
            if not cands:
                break
            (g, pos, thr), (a, b) = max(cands, key=lambda t: (t[0][0], -t[0][2]))
            leaves.remove((a, b))
            leaves += [(a, pos), (pos, b)]
            cuts.append(thr)
    else:
        level = [(0, n)]
        for _ in range(max_depth):
            nxt = []
            for a, b in level:
                c = best(a, b)
                if c:
                    cuts.append(c[2])
                    nxt += [(a, c[1]), (c[1], b)]
            level = nxt
    return sorted(cuts)


def pava(x, y, w=None):
    """Increasing isotonic fit at the distinct sorted x (equal x pooled)."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    w = np.ones_like(y) if w is None else np.asarray(w, float)
    xs = np.unique(x)
    sy = np.array([np.sum(y[x == v] * w[x == v]) for v in xs])
    sw = np.array([np.sum(w[x == v]) for v in xs])
    blocks = []  # (sum_y, sum_w, count)
    for a, b in zip(sy, sw):
        blocks.append([a, b, 1])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] > blocks[-1][0] / blocks[-1][1]:
            a2, b2, c2 = blocks.pop()
            blocks[-1][0] += a2
            blocks[-1][1] += b2
            blocks[-1][2] += c2
    fit = np.concatenate([[s / ww] * c for s, ww, c in blocks])
    return xs, fit


def newton_logistic(X, y, w, C=1.0, iters=50):
    """sklearn objective: 0.5 ||beta||^2 + C * sum w_i logloss_i, intercept unpenalised."""
    X1 = np.hstack([np.ones((X.shape[0], 1)), X])
    beta = np.zeros(X1.shape[1])
    reg = np.eye(X1.shape[1])
    reg[0, 0] = 0.0
    for _ in range(iters):
        p = 1 / (1 + np.exp(-X1 @ beta))
        g = C * X1.T @ (w * (p - y)) + reg @ beta
        H = C * (X1.T * (w * p * (1 - p))) @ X1 + reg
        step = np.linalg.solve(H, g)
        beta -= step
        if np.max(np.abs(step)) < 1e-12:
            break
    return beta[0], beta[1:]


def auc(y, p):
    y, p = np.asarray(y), np.asarray(p)
    pos, neg = p[y == 1], p[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum()
    eq = (pos[:, None] == neg[None, :]).sum()
    return (gt + 0.5 * eq) / (len(pos) * len(neg))


def qcut_codes(x, q=10):
    """pd.qcut(x, q, labels=False, duplicates='drop') semantics."""
    edges = np.unique(np.quantile(np.asarray(x, float), np.linspace(0, 1, q + 1)))
    inner = edges[1:-1]
    return np.searchsorted(inner, x, side="left")


def ceil_frac(frac, n):
    return math.ceil(frac * n)
