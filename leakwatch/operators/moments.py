"""The state of the adaptive baseline, as used inside tasks: columns over many sources.

A source has a count, means and squared deviations of 17 features, so its size never grows. All
sources of a step advance at once, one window each. The batch and the streaming monitor share it;
reasons are not made here, but by column expressions over what a step returns.
"""

import numpy as np

from leakwatch.functions import fixed

NAMES = fixed.RUNTIME_FEATURES
WEIGHTS = np.array([fixed.BASELINE_WEIGHTS[n] for n in NAMES])


class Baselines:
    """Running moments of the features, one row per source."""

    def __init__(self, size=0):
        self.n = np.zeros(size, np.int64)
        self.warm = np.zeros(size, bool)
        self.mean = np.zeros((size, len(NAMES)))
        self.m2 = np.zeros((size, len(NAMES)))

    def grow(self, size):
        """Room for at least `size` sources."""
        more = max(size, 2 * len(self.n)) - len(self.n)
        self.n = np.concatenate([self.n, np.zeros(more, np.int64)])
        self.warm = np.concatenate([self.warm, np.zeros(more, bool)])
        self.mean = np.concatenate([self.mean, np.zeros((more, len(NAMES)))])
        self.m2 = np.concatenate([self.m2, np.zeros((more, len(NAMES)))])

    def step(self, at, x, threshold, warmup):
        """One window `x` of each of the sources `at` (no source twice).

        Scores the windows against the past, then learns those that are not flagged. Returns warm, score,
        flagged, count after the window, and count, means and deviations before it.
        """
        n, mean, m2 = self.n[at], self.mean[at], self.m2[at]
        warm = self.warm[at] | (n >= warmup)
        std = np.sqrt(m2 / np.maximum(n, 1)[:, None])
        std[n < 2] = 0.0
        varies = std >= fixed.STD_FLOOR
        z = np.where(varies, np.abs(x - mean) / np.where(varies, std, 1.0), 0.0)
        share = (WEIGHTS * np.minimum(z, fixed.Z_CAP) / fixed.Z_THRESHOLD).sum(axis=1) / WEIGHTS.sum()
        score = np.where(warm, np.minimum(share, 1.0), 0.0)
        flagged = warm & (score >= threshold)
        after = n + ~flagged
        gap = x - mean
        moved = mean + gap / np.maximum(after, 1)[:, None]
        learned = ~flagged[:, None]
        self.n[at], self.warm[at] = after, warm
        self.mean[at] = np.where(learned, moved, mean)
        self.m2[at] = np.where(learned, m2 + gap * (x - moved), m2)
        return warm, score, flagged, after, n, mean, std


def rounds(at):
    """Split places into groups in which none occurs twice, in order of occurrence."""
    order = np.argsort(at, kind="stable")
    ordered = at[order]
    first = np.searchsorted(ordered, ordered)
    turn = np.empty(len(at), np.int64)
    turn[order] = np.arange(len(at)) - first
    return [np.flatnonzero(turn == t) for t in range(int(turn.max(initial=-1)) + 1)]
