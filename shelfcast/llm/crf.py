"""Linear-chain conditional random fields: likelihood gradient and Viterbi over many chains at once."""

from __future__ import annotations

import numpy as np


def _log_sum(a, axis):
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def crf_gradient(scores, trans, tags):
    """Negative log likelihood per window and its gradients by scores and transitions."""
    steps, k, n = scores.shape
    alpha = np.empty_like(scores)
    beta = np.zeros_like(scores)
    alpha[0] = scores[0]
    for t in range(1, steps):
        alpha[t] = scores[t] + _log_sum(alpha[t - 1][:, None, :] + trans[:, :, None], 0)
    for t in range(steps - 2, -1, -1):
        beta[t] = _log_sum(trans[:, :, None] + (scores[t + 1] + beta[t + 1])[None], 1)
    whole = _log_sum(alpha[-1], 0)
    d_scores = np.exp(alpha + beta - whole)
    d_trans = np.zeros((k, k))
    for t in range(1, steps):
        d_trans += np.exp(alpha[t - 1][:, None, :] + trans[:, :, None] + (scores[t] + beta[t])[None] - whole).sum(axis=2)
    columns = np.arange(n)
    gold = np.zeros(n)
    for t in range(steps):
        d_scores[t, tags[t], columns] -= 1
        gold += scores[t, tags[t], columns]
        if t:
            np.add.at(d_trans, (tags[t - 1], tags[t]), -1)
            gold += trans[tags[t - 1], tags[t]]
    return (whole - gold).mean(), (d_scores / n).astype(np.float32), (d_trans / n).astype(np.float32)


def viterbi(scores: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best tags (time, window)."""
    steps, _, n = scores.shape
    back = np.empty(scores.shape, np.int8)
    best = scores[0]
    for t in range(1, steps):
        paths = best[:, None, :] + trans[:, :, None]
        back[t] = paths.argmax(axis=0)
        best = paths.max(axis=0) + scores[t]
    out = np.empty((steps, n), np.int8)
    out[-1] = best.argmax(axis=0)
    columns = np.arange(n)
    for t in range(steps - 1, 0, -1):
        out[t - 1] = back[t, out[t], columns]
    return out
