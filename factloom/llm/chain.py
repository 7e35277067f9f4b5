"""Linear-chain conditional random fields over many sequences at once (numpy)."""

from __future__ import annotations

import numpy as np

BLOCK = 64


def posterior_sums(emission: np.ndarray, transition: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Forward-backward: for each sequence the sum over its items of the labels' posteriors.

    emission: log potentials (items, labels); transition: log potentials (labels, labels);
    sequence i has the items first[i]:first[i + 1].  The chain is exact over the whole sequence:
    blocks of 64 items are reduced to one matrix each, these are chained, then blocks are filled in.
    """
    out, alpha, beta, index, live = _lattice(emission, transition, first)
    if alpha is None:
        return out
    post = alpha * beta
    post /= post.sum(axis=2, keepdims=True)
    post[~live] = 0
    np.add.at(out, index, post.sum(axis=1))
    return out


def posteriors(emission: np.ndarray, transition: np.ndarray, first: np.ndarray):
    """Per item the labels' posteriors, and per neighbouring pair the expected transitions summed."""
    labels = emission.shape[1]
    _, alpha, beta, _, live = _lattice(emission, transition, first)
    if alpha is None:
        return np.zeros((0, labels)), np.zeros((labels, labels))
    post = alpha * beta
    post = (post / post.sum(axis=2, keepdims=True))[live]
    a, b = alpha[live], beta[live]
    inner = np.ones(len(a), bool)
    inner[first[:-1][first[:-1] < len(a)]] = False
    at = np.flatnonzero(inner)
    e = np.exp(emission - emission.max(axis=1, keepdims=True))
    pair = a[at - 1][:, :, None] * np.exp(transition)[None] * (e[at] * b[at])[:, None, :]
    pair /= pair.sum(axis=(1, 2), keepdims=True)
    return post, pair.sum(axis=0)


def _lattice(emission, transition, first):
    labels, lengths = emission.shape[1], np.diff(first)
    out = np.zeros((len(lengths), labels))
    per = -(-lengths // BLOCK)
    blocks = int(per.sum())
    if not blocks:
        return out, None, None, None, None
    index = np.repeat(np.arange(len(lengths)), per)
    head = np.cumsum(per) - per
    within = np.arange(blocks) - head[index]
    begin = first[:-1][index] + within * BLOCK
    size = np.minimum(BLOCK, first[1:][index] - begin)
    live = np.arange(BLOCK)[None, :] < size[:, None]
    e = np.ones((blocks, BLOCK, labels))
    e[live] = np.exp(emission - emission.max(axis=1, keepdims=True))
    t = np.exp(transition - transition.max())
    product = np.broadcast_to(np.eye(labels), (blocks, labels, labels)).copy()
    for j in range(BLOCK):
        step = (product @ t) * e[:, j, None, :]
        step /= step.sum(axis=(1, 2), keepdims=True)
        product = np.where(live[:, j, None, None], step, product)
    enter = np.full((blocks, labels), 1.0 / labels)
    leave = np.ones((blocks, labels))
    order = np.argsort(-per, kind="stable")
    counts = np.searchsorted(-per[order], -np.arange(per.max()), side="left")
    for k in range(1, int(per.max())):
        b = head[order[: counts[k]]] + k
        v = (enter[b - 1][:, None, :] @ product[b - 1])[:, 0]
        enter[b] = v / v.sum(axis=1, keepdims=True)
    for k in range(int(per.max()) - 1, 0, -1):
        b = head[order[: counts[k]]] + k
        v = (product[b] @ leave[b][:, :, None])[:, :, 0]
        leave[b - 1] = v / v.sum(axis=1, keepdims=True)
    alpha, beta = np.empty_like(e), np.empty_like(e)
    v = enter
    for j in range(BLOCK):
        step = (v @ t) * e[:, j]
        step /= step.sum(axis=1, keepdims=True)
        v = np.where(live[:, j, None], step, v)
        alpha[:, j] = v
    v = leave
    for j in range(BLOCK - 1, -1, -1):
        beta[:, j] = v
        step = (e[:, j] * v) @ t.T
        step /= step.sum(axis=1, keepdims=True)
        v = np.where(live[:, j, None], step, v)
    return out, alpha, beta, index, live


def viterbi(emission: np.ndarray, transition: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The most probable label of every item; ties take the smaller label."""
    lengths = np.diff(first)
    best = np.zeros(len(emission), np.int64)
    if not len(emission):
        return best
    order = np.argsort(-lengths, kind="stable")
    most = int(lengths.max())
    counts = np.searchsorted(-lengths[order], -np.arange(most), side="left")
    came = np.zeros(emission.shape, np.int8)
    score = np.zeros((len(lengths), emission.shape[1]))
    for t in range(most):
        docs = order[: counts[t]]
        at = first[docs] + t
        if t == 0:
            score[docs] = emission[at]
            continue
        options = score[docs][:, :, None] + transition[None]
        came[at] = options.argmax(axis=1)
        score[docs] = options.max(axis=1) + emission[at]
    state = score.argmax(axis=1)
    for t in range(most - 1, -1, -1):
        docs = order[: counts[t]]
        at = first[docs] + t
        best[at] = state[docs]
        state[docs] = came[at, state[docs]]
    return best


def fit(features, weights_shape, labels, first, rounds=60, rate=0.3, l2=1e-4, class_weight=None):
    """Adam on the conditional log-likelihood; features: (items, k) indices of active features (-1: none).

    Returns (weights, transition).
    """
    size, count = weights_shape
    w, t = np.zeros((size + 1, count)), np.zeros((count, count))
    flat = np.where(features < 0, size, features).ravel()
    width = features.shape[1]
    n = max(1, len(features))
    truth = np.eye(count)[labels]
    inner = np.ones(len(labels), bool)
    inner[first[:-1][first[:-1] < len(labels)]] = False
    at = np.flatnonzero(inner)
    pairs = np.zeros((count, count))
    np.add.at(pairs, (labels[at - 1], labels[at]), 1)
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)]
    weight = np.ones(n) if class_weight is None else class_weight[labels]
    for r in range(1, rounds + 1):
        emission = w[flat].reshape(-1, width, count).sum(axis=1)
        post, expected = posteriors(emission, t, first)
        error = (truth - post) * weight[:, None]
        gw = np.stack([np.bincount(flat, np.repeat(error[:, c], width), size + 1) for c in range(count)], 1) / n - l2 * w
        gt = (pairs - expected) / n - l2 * t
        for x, g, a, b in ((w, gw, 0, 1), (t, gt, 2, 3)):
            moments[a] = 0.9 * moments[a] + 0.1 * g
            moments[b] = 0.99 * moments[b] + 0.01 * g * g
            x += rate * (moments[a] / (1 - 0.9**r)) / (np.sqrt(moments[b] / (1 - 0.99**r)) + 1e-7)
        w[size] = 0
    return w, t
