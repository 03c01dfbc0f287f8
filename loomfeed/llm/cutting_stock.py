"""One-dimensional cutting stock over a histogram, by column generation."""

from __future__ import annotations

import numpy as np

TOLERANCE = 1e-4
#: Accepted distance from the best lower bound (of the material, or of the prices).
GAP = 5e-4
#: Weight of the best prices so far.
STEADY = 0.7
MAX_COLUMNS = 5_000
#: Columns after which the inverse is computed anew.
REFRESH = 500


def price(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the best value and how often each size is used."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), "right").tolist()
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if fits[room]:
            gains = best[room - sizes[: fits[room]]] + values[: fits[room]]
            top = int(gains.argmax())
            if gains[top] > best[room] + 1e-12:
                best[room], choice[room] = gains[top], top
    used, room = np.zeros(len(sizes), dtype=np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            used[choice[room]] += 1
            room -= int(sizes[choice[room]])
    return float(best[capacity]), used


def inverted(basis: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with partial pivots; a few hundred rows need no threaded library."""
    n = len(basis)
    both = np.hstack((basis, np.eye(n)))
    for i in range(n):
        pivot = i + int(np.abs(both[i:, i]).argmax())
        both[[i, pivot]] = both[[pivot, i]]
        both[i] /= both[i, i]
        factor = both[:, i].copy()
        factor[i] = 0
        both -= np.outer(factor, both[i])
    return both[:, n:]


def start(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> np.ndarray:
    """A feasible basis: greedy patterns, largest sizes first, each cut until a size is used up."""
    left, columns = demand.copy(), []
    while (open_sizes := np.flatnonzero(left > 0)).size:
        column, room = np.zeros(len(sizes)), capacity
        for i in open_sizes[::-1]:
            column[i] = min(room // sizes[i], np.ceil(left[i]))
            room -= int(column[i] * sizes[i])
        used = np.flatnonzero(column)
        times = (left[used] / column[used]).min()
        done = used[left[used] <= times * column[used] + 1e-9]
        left[used] -= times * column[used]
        left[done] = 0
        columns.append(column)
        for i in done[1:]:  # used up together: a pattern of its own keeps the basis whole
            columns.append(np.where(np.arange(len(sizes)) == i, capacity // sizes[i], 0))
    return np.array(columns, dtype=float).T


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The linear program: patterns (columns) of the last basis and how often each is cut.

    Sizes ascend and are 1 to ``capacity``, demands are positive. It ends within
    ``GAP`` of a lower bound, or with no better column, or after ``MAX_COLUMNS``;
    the basis meets the demands at any time.
    """
    basis = start(sizes, demand, capacity)
    inverse = inverted(basis)
    amounts = np.maximum(inverse @ demand, 0)
    bound = float(sizes @ demand) / capacity
    center = sizes / capacity
    for turn in range(1, MAX_COLUMNS):
        if turn % REFRESH == 0:
            inverse = inverted(basis)
            amounts = np.maximum(inverse @ demand, 0)
        cost = float(amounts.sum())
        if cost <= bound * (1 + GAP):
            break
        duals = inverse.sum(axis=0)
        # priced near the best prices so far, which keeps the columns from swinging
        tried = STEADY * center + (1 - STEADY) * duals
        value, column = price(tried, sizes, capacity)
        if value > 0 and tried @ demand / value > bound:
            bound, center = float(tried @ demand / value), tried / value
        if column @ duals <= 1 + TOLERANCE:
            value, column = price(duals, sizes, capacity)
            if value > 0 and duals @ demand / value > bound:
                bound, center = float(duals @ demand / value), duals / value
            if value <= 1 + TOLERANCE:
                break
        change = np.einsum("ij,j->i", inverse, column.astype(float))
        positive = change > 1e-9
        ratio = np.where(positive, amounts / np.where(positive, change, 1), np.inf)
        # of equal ratios the largest pivot, for accuracy
        tied = np.flatnonzero(ratio <= ratio.min() + 1e-9)
        leave = int(tied[change[tied].argmax()])
        step = ratio[leave]
        amounts = np.maximum(amounts - step * change, 0)
        amounts[leave] = step
        basis[:, leave] = column
        row = inverse[leave] / change[leave]
        inverse -= np.outer(change, row)
        inverse[leave] = row
    return basis.astype(np.int64), amounts


def patterns(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Whole patterns ``({size: pieces}, times)`` that cut exactly the histogram.

    The linear program is rounded down; what is left (fewer pieces than one of
    each pattern) is packed first-fit by falling size. There are at most two
    patterns per size besides the ones of the rest.
    """
    demand = {s: n for s, n in sorted(histogram.items()) if n > 0}
    if not demand:
        return []
    sizes = np.array(list(demand), dtype=np.int64)
    left = np.array(list(demand.values()), dtype=np.int64)
    columns, amounts = solve(sizes, left.astype(float), capacity)
    out = []
    for column, amount in zip(columns.T, np.floor(amounts + 1e-6).astype(np.int64), strict=True):
        used = column > 0
        times = int(min(amount, (left[used] // column[used]).min())) if used.any() else 0
        if times > 0:
            left = left - times * column
            out.append(({int(s): int(c) for s, c in zip(sizes, column, strict=True) if c}, times))
    bins: list[tuple[int, dict[int, int]]] = []
    for size, count in zip(sizes[::-1].tolist(), left[::-1].tolist(), strict=True):
        for _ in range(count):
            for i, (room, content) in enumerate(bins):
                if size <= room:
                    content[size] = content.get(size, 0) + 1
                    bins[i] = (room - size, content)
                    break
            else:
                bins.append((capacity - size, {size: 1}))
    return out + [(content, 1) for _, content in bins]
