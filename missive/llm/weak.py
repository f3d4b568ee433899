"""Weak labels: expectation-maximisation over the votes of overlapping labellers.

Votes are 0 (no opinion), 1 (first class) or 2 (second class).  Rows with the same votes are alike, so the model is
fitted on the table of vote patterns and their counts, at most ``3 ** labellers`` rows, whatever the input.
"""

from __future__ import annotations

import numpy as np


#: Chances of silence, of the right vote and of the wrong vote that the estimates start from.
START = (0.55, 0.42, 0.03)
#: What the start weighs against the rows, as a share of them: the result doesn't depend on the table's size.
START_WEIGHT = 0.02
#: Log-odds that a vote carries at least.
LEAST = 0.7


def fit(patterns: np.ndarray, counts: np.ndarray, prior: float = 0.2, rounds: int = 500) -> dict:
    """What each labeller does in either class, the share of the second class, and each pattern's posterior of it.

    ``accuracy[labeller, class, vote]`` holds the chances of the three votes.  Silence is no evidence; a vote counts
    by the ratio of its chances in the two classes, and by ``LEAST`` at least in its own direction, as labellers are
    taken to be better than chance.  ``START`` and ``LEAST`` keep the classes from changing places.
    """
    if not len(counts):
        return {"accuracy": np.empty((0, 2, 3)), "share": prior, "posterior": np.empty(0)}
    votes = np.asarray(patterns, np.int64).reshape(len(counts), -1)
    counts = np.asarray(counts, np.float64)
    told = np.stack([votes == v for v in range(3)], 2).astype(np.float64)  # row, labeller, vote
    silent, right, wrong = START
    pseudo = np.array([[silent, right, wrong], [silent, wrong, right]]) * max(1.0, START_WEIGHT * counts.sum())
    accuracy = np.broadcast_to(pseudo / pseudo.sum(1, keepdims=True), (votes.shape[1], 2, 3))
    share, posterior = prior, np.full(len(counts), prior)
    for _ in range(rounds):
        odds = np.log(accuracy[:, 1] / accuracy[:, 0])
        odds[:, 0] = 0.0
        odds[:, 1], odds[:, 2] = np.minimum(odds[:, 1], -LEAST), np.maximum(odds[:, 2], LEAST)
        z = np.einsum("rlv,lv->r", told, odds) + np.log(share) - np.log1p(-share)
        new = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
        weight = np.stack([(1.0 - new) * counts, new * counts])
        seen = np.einsum("cr,rlv->lcv", weight, told) + pseudo
        accuracy = seen / seen.sum(2, keepdims=True)
        share = float((weight[1].sum() + 1.0) / (counts.sum() + 2.0))
        settled = np.abs(new - posterior).max() < 1e-9
        posterior = new
        if settled:
            break
    return {"accuracy": accuracy, "share": share, "posterior": posterior}


def logistic(
    features: np.ndarray, target: np.ndarray, weight: np.ndarray, penalty: float = 1e-3, rounds: int = 300
) -> np.ndarray:
    """Weights of a logistic regression on soft targets; the last one is the intercept.

    Conjugate-gradient Newton steps on a dense matrix of the bounded training sample.
    """
    x = np.hstack([features, np.ones((len(features), 1), features.dtype)])
    total = max(weight.sum(), 1e-12)
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-9
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -50, 50)))
        gradient = x.T @ ((p - target) * weight) / total + ridge * w
        if np.abs(gradient).max() < 1e-6:
            break
        curve = p * (1 - p) * weight / total + 1e-9
        step, residual = np.zeros_like(w), -gradient
        direction, norm = residual.copy(), residual @ residual
        for _ in range(50):
            along = x.T @ (curve * (x @ direction)) + ridge * direction
            size = norm / max(direction @ along, 1e-300)
            step += size * direction
            residual -= size * along
            fresh = residual @ residual
            if fresh < 1e-4 * norm and fresh < 1e-12:
                break
            direction, norm = residual + fresh / max(norm, 1e-300) * direction, fresh
        w += step
    return w
