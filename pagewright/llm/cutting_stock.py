"""Cutting stock by column generation: which piece lengths to put together.

The input is a histogram of lengths in units of the capacity, so the work here is
bounded by the capacity and not by the number of pieces.
"""

from __future__ import annotations

import numpy as np


def price(duals: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of highest worth, by dynamic programming over the knapsack's fill."""
    worth = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1, dtype=np.int64)
    good = duals > 1e-12
    s, d = sizes[good], duals[good]
    index = np.flatnonzero(good)
    for fill in range(1, capacity + 1):
        worth[fill], last[fill] = worth[fill - 1], -1
        n = np.searchsorted(s, fill, side="right")
        if n:
            gain = worth[fill - s[:n]] + d[:n]
            k = int(gain.argmax())
            if gain[k] > worth[fill] + 1e-12:
                worth[fill], last[fill] = gain[k], k
    pattern, fill = np.zeros(len(sizes)), capacity
    while fill > 0:
        if last[fill] < 0:
            fill -= 1
        else:
            pattern[index[last[fill]]] += 1
            fill -= int(s[last[fill]])
    return float(worth[capacity]), pattern


def relax(sizes: np.ndarray, counts: np.ndarray, capacity: int, gap: float = 1e-3, rounds: int = 4000):
    """Columns and amounts of the linear program ``min sum x`` with every length covered
    exactly, to within ``gap`` of its optimum (Farley's bound)."""
    m = len(sizes)
    columns = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1.0 / (capacity // sizes))
    amount = counts / (capacity // sizes)
    for step in range(rounds):
        duals = inverse.sum(axis=0)
        worth, new = price(duals, sizes, capacity)
        if worth <= 1 + gap:
            break
        direction = inverse @ new
        rising = direction > 1e-9
        if not rising.any():
            break
        ratio = np.where(rising, amount / np.where(rising, direction, 1.0), np.inf)
        out = int(ratio.argmin())
        t = ratio[out]
        amount = np.maximum(amount - t * direction, 0.0)
        amount[out] = t
        columns[:, out] = new
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
        if step % 200 == 199:
            inverse = np.linalg.inv(columns)
            amount = np.maximum(inverse @ counts, 0.0)
    return columns, amount


def best_fit(pieces: list[int], capacity: int) -> list[list[int]]:
    """Patterns for single pieces, given in falling order: each goes to the fullest bin that has room."""
    by_room: dict[int, list[list[int]]] = {}
    for p in pieces:
        room = next((r for r in range(p, capacity + 1) if by_room.get(r)), None)
        home = by_room[room].pop() if room is not None else []
        home.append(p)
        by_room.setdefault((room if room is not None else capacity) - p, []).append(home)
    return [b for bins in by_room.values() for b in bins]


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """``(times, {length: copies})`` that use every length as often as ``counts`` has it.

    The linear program's amounts are rounded down; what they leave, at most a pattern
    per length, is packed by best fit.
    """
    sizes = np.array(sorted(k for k, n in counts.items() if n > 0), dtype=np.int64)
    if not len(sizes):
        return []
    left = np.array([counts[int(s)] for s in sizes], dtype=np.int64)
    columns, amount = relax(sizes, left.astype(float), capacity)
    out: list[tuple[int, dict[int, int]]] = []
    for j in np.argsort(-amount, kind="stable"):
        column = columns[:, j].round().astype(np.int64)
        times = int(np.floor(amount[j] + 1e-7))
        if column.any():
            times = min(times, int((left[column > 0] // column[column > 0]).min()))
        if times > 0 and column.any():
            left -= times * column
            out.append((times, {int(s): int(c) for s, c in zip(sizes, column) if c}))
    rest = best_fit([int(s) for s, n in zip(sizes[::-1], left[::-1]) for _ in range(int(n))], capacity)
    same: dict[tuple, int] = {}
    for b in rest:
        same[tuple(sorted(b))] = same.get(tuple(sorted(b)), 0) + 1
    for b, times in sorted(same.items()):
        out.append((times, {s: b.count(s) for s in sorted(set(b))}))
    return out
