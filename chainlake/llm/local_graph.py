"""Connected sets of a bounded local graph, with numpy."""

from __future__ import annotations

import numpy as np


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Fold links a[i]-b[i] into `label`, where label[i] <= i names i's set by its least member.

    Every set stays flat: label[label] == label before and after.
    """
    while len(a):
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up
