"""Cutting stock by column generation, over a histogram of sizes.

The histogram has at most as many sizes as a sequence has tokens, whatever the corpus, and they
are joined into a fixed number of classes; so the linear program is of a fixed size and is solved
on the driver.
"""

from __future__ import annotations

import heapq
import logging

import numpy as np

#: The program ends when its value is proven to be within this share of the best.
GAP = 2e-3
#: Size classes of the program, and new columns for each after which a warning ends it.
CLASSES = 128
COLUMNS_A_CLASS = 20


def classes(sizes: np.ndarray, demand: np.ndarray, most: int = CLASSES) -> np.ndarray:
    """For each of the ascending sizes the size of its class, at which its pieces are counted.

    Neighbouring classes are joined, the pair that wastes the fewest tokens first, until ``most``
    are left. With no more sizes than that, every size is a class and nothing is rounded.
    """
    count = len(sizes)
    upper, pieces = sizes.astype(np.int64).tolist(), demand.astype(np.int64).tolist()
    after, before = list(range(1, count + 1)), list(range(-1, count - 1))
    alive, joined_to = [True] * count, list(range(count))

    def waste(k: int) -> tuple[int, int, int, int]:
        return pieces[k] * (upper[after[k]] - upper[k]), k, after[k], pieces[k]

    heap = [waste(k) for k in range(count - 1)]
    heapq.heapify(heap)
    for _ in range(count - most):
        while True:
            _, k, following, then = heapq.heappop(heap)
            if alive[k] and after[k] == following and pieces[k] == then:
                break
        # Pieces of class k are counted at the size of the next one.
        alive[k], joined_to[k] = False, following
        pieces[following] += pieces[k]
        before[following] = before[k]
        if before[k] >= 0:
            after[before[k]] = following
            heapq.heappush(heap, waste(before[k]))
        if after[following] < count:
            heapq.heappush(heap, waste(following))
    for k in range(count - 1, -1, -1):
        joined_to[k] = joined_to[joined_to[k]]
    return sizes[np.array(joined_to, np.int64)] if count else sizes


def best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within the capacity, by dynamic programming."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if k := fitting[room]:
            worth = best[room - sizes[:k]] + values[:k]
            top = int(np.argmax(worth))
            if worth[top] > best[room] + 1e-12:
                best[room], choice[room] = worth[top], top
    pattern, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(best[capacity]), pattern


def relaxed(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often to use each, of the relaxed program, by the revised
    simplex method; the knapsack prices new columns."""
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(basis))
    used = inverse @ demand
    # What no packing can undercut: full sequences, and the bounds that prices give.
    bound = float(demand @ sizes) / capacity
    for _ in range(COLUMNS_A_CLASS * len(sizes)):
        prices = inverse.sum(axis=0)
        value, column = best_pattern(prices, sizes, capacity)
        bound = max(bound, used.sum() / max(value, 1.0))
        if used.sum() <= (1 + GAP) * bound:
            break
        step = inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, used / step, np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        used = np.maximum(used - ratio[out] * step, 0.0)
        used[out] = ratio[out]
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        basis[:, out] = column
    else:
        logging.getLogger(__name__).warning("patterns take %.1f, the bound is %.1f", used.sum(), bound)
    return basis, used


def cut(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[int, np.ndarray]]:
    """(copies, pattern) that hold the whole demand exactly.

    The program's patterns are rounded down, then used once more each, the most wanted first, as
    long as the rest fills them. What remains is packed largest first.
    """
    chosen: list[tuple[int, np.ndarray]] = []
    if not len(sizes):
        return chosen
    patterns, used = relaxed(sizes, demand.astype(float), capacity)
    left = demand.astype(np.int64)
    for k in np.argsort(-used, kind="stable"):
        pattern = patterns[:, k].astype(np.int64)
        if not pattern.any():
            continue
        copies = min(int(used[k] + 1e-6), int(np.min(left[pattern > 0] // pattern[pattern > 0])))
        if copies > 0:
            chosen.append((copies, pattern))
            left = left - copies * pattern
    for k in np.argsort(-(used % 1.0), kind="stable"):
        pattern = patterns[:, k].astype(np.int64)
        if pattern.any() and pattern @ sizes >= 0.98 * capacity and np.all(left >= pattern):
            chosen.append((1, pattern))
            left = left - pattern
    while left.any():
        pattern, room = np.zeros(len(sizes), np.int64), capacity
        for i in range(len(sizes) - 1, -1, -1):
            if left[i] and sizes[i] <= room:
                pattern[i] = min(left[i], room // sizes[i])
                room -= int(pattern[i] * sizes[i])
        copies = int(np.min(left[pattern > 0] // pattern[pattern > 0]))
        chosen.append((copies, pattern))
        left = left - copies * pattern
    return chosen


def places(chosen: list[tuple[int, np.ndarray]], sizes: np.ndarray) -> dict[str, np.ndarray]:
    """Where the ranked pieces of each size go: rows of (size, first rank, pieces a sequence,
    first sequence, first slot), sorted by size and rank. Numbers only; nothing per piece."""
    taken = np.zeros(len(sizes), np.int64)
    rows, sequence = [], 0
    for copies, pattern in chosen:
        slot = 0
        for i in np.flatnonzero(pattern):
            rows.append((int(sizes[i]), int(taken[i]), int(pattern[i]), sequence, slot))
            taken[i] += copies * pattern[i]
            slot += int(pattern[i])
        sequence += copies
    rows.sort()
    names = ("size", "rank", "each", "sequence", "slot")
    columns = zip(*rows, strict=True) if rows else [()] * 5
    return {n: np.array(c, np.int64) for n, c in zip(names, columns, strict=True)}
