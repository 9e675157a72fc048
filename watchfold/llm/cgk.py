"""CGK random walks over texts: the shared random bits and their step tables."""

from __future__ import annotations

import numpy as np

from watchfold.llm.common import mix64


def walk_steps(repetition: int, period: int) -> list[bytes]:
    """For each symbol (0-255) and step: how many steps until the walk has moved on.

    At every step a shared random bit for (step, symbol) decides whether the walk moves
    to the next symbol; the bits repeat after ``period`` steps.
    """
    grid = np.arange(period * 256, dtype=np.uint64) + np.uint64((repetition + 1) << 32)
    moves = (mix64(grid) >> np.uint64(63)).astype(bool).reshape(256, period)
    twice = np.concatenate([moves, moves], axis=1)
    twice[:, -1] = True
    at = np.where(twice, np.arange(2 * period), 4 * period)
    ahead = np.minimum.accumulate(at[:, ::-1], axis=1)[:, ::-1]
    steps = np.minimum(ahead - np.arange(2 * period) + 1, 255)[:, :period].astype(np.uint8)
    return [row.tobytes() for row in steps]
