"""How many sequences of which composition hold all pieces, from the histogram of their lengths.

The histogram has at most ``capacity`` entries, so this runs on the driver, whatever the number of
pieces. The plan is a configuration linear program: one variable per composition that fits a
sequence, one covering row per length, as few sequences as possible. It is solved by multiplicative
weights. A length's weight falls with the share of its pieces that is covered; a knapsack over the
weights (dynamic programming over the room) gives the best composition through each length; of
those, the ones through the least covered lengths are used until these have risen by a step. When
all are covered, the compositions used, scaled, are the averaged solution, and the weights prove
a lower bound: their worth of all pieces over that of the best composition. While the solution is
more than ``GAP`` above the bound, another pass starts from the average weights with half the step.

The solution is rounded down, amounts carried from one composition to the next, as far as there are
pieces. What is left is solved (in one pass) and rounded again while it needs more sequences than it
has lengths; best fit places the rest.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np

#: A solution this near to the proven bound, as a part of it, ends the passes; so does this number
#: of knapsacks (5 to 15 seconds on the driver, and a last pass of at most twice as many), after
#: which the gap that is proven can be larger: up to about 0.1 with 2,000 different lengths.
GAP, KNAPSACKS = 0.02, 400
#: Share of a length's pieces covered in a step of the first pass, and how fast weights fall with it.
STEP, RATE = 0.02, 20.0
#: Least covered lengths served in a step: this part of all, but at least eight.
SERVED = 20


def _knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int):
    """The largest value of a multiset of ``sizes`` (ascending) within each room up to
    ``capacity``, the size taken there, as its place, and the largest room up to each in which one
    is taken (0: none).
    """
    value, place = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    value[sizes], place[sizes] = values, np.arange(len(sizes))
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    total = np.empty(capacity)
    for room in range(int(sizes[0]), capacity + 1):
        np.add(value[1 : room + 1], best[room - 1 :: -1], out=total[:room])
        size = int(total[:room].argmax()) + 1
        best[room] = best[room - 1]
        if total[size - 1] > best[room]:
            best[room], last[room] = total[size - 1], place[size]
    taken = np.maximum.accumulate(np.where(last >= 0, np.arange(capacity + 1), 0))
    return best, last, taken


def _compositions(
    sizes: np.ndarray, last: np.ndarray, taken: np.ndarray, through: np.ndarray, capacity: int
) -> np.ndarray:
    """For each place in ``through``, how often the best composition with that size has each."""
    found = np.zeros((len(through), len(sizes)), np.int64)
    rows = np.arange(len(through))
    found[rows, through] = 1
    room = capacity - sizes[through]
    while len(rows):
        room = taken[room]
        rows, room = rows[room > 0], room[room > 0]
        found[rows, last[room]] += 1
        room = room - sizes[last[room]]
    return found


def _cover(sizes, demand, capacity, start, step):
    """One pass: how much of each composition covers ``demand``, the lower bound that its weights
    prove, the logarithm of their average (``start`` is that of the first weights), and the number of
    knapsacks.
    """
    covered, used = np.zeros(len(sizes)), defaultdict(float)
    served = min(len(sizes), max(8, len(sizes) // SERVED))
    bound, average, steps = 0.0, np.zeros(len(sizes)), 0
    while (low := covered.min()) < 1:
        weights = np.exp(start - RATE * (covered - low))
        best, last, taken = _knapsack(sizes, weights, capacity)
        weights /= best[capacity]
        bound = max(bound, weights @ demand)
        average, steps = average + weights, steps + 1
        least = np.argsort(covered, kind="stable")[:served]
        upto = covered[least] + step
        for k, row in enumerate(_compositions(sizes, last, taken, least, capacity)):
            amount = (upto[k] - covered[least[k]]) * demand[least[k]] / row[least[k]]
            if amount > 0:  # else others through this length have covered it meanwhile
                some = np.flatnonzero(row)
                covered[some] += amount * row[some] / demand[some]
                used[np.stack([some, row[some]]).astype(np.int16).tobytes()] += amount
    solution = {key: amount / low for key, amount in used.items()}
    return solution, bound, np.log(average / steps), steps


def solve(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP
) -> tuple[dict, float]:
    """Amounts of compositions that cover ``demand``, and a proven lower bound of what any solution
    needs. A composition is the bytes of 16-bit places in ``sizes``, then of their counts.
    """
    start, step = np.log(sizes / capacity), STEP
    bound, best, knapsacks = demand @ sizes / capacity, None, 0
    while True:
        solution, proven, start, steps = _cover(sizes, demand, capacity, start, step)
        bound, knapsacks = max(bound, proven), knapsacks + steps
        if best is None or sum(solution.values()) < sum(best.values()):
            best = solution
        step /= 2
        if sum(best.values()) <= (1 + gap) * bound or knapsacks >= KNAPSACKS:
            return best, bound


def _rounded(left: np.ndarray, capacity: int, gap: float) -> list[tuple[dict[int, int], int]]:
    """Compositions with how often each is used: the solution rounded, largest amounts first, as
    far as pieces are left. Takes them out of ``left``.
    """
    sizes = np.flatnonzero(left)
    solution, _ = solve(sizes, left[sizes].astype(float), capacity, gap)
    used, carried = [], 0.0
    for key, amount in sorted(solution.items(), key=lambda item: (-item[1], item[0])):
        some, counts = np.frombuffer(key, np.int16).reshape(2, -1)
        carried += amount
        whole = int(carried + 1e-9)
        carried -= whole
        times = min(whole, int((left[sizes[some]] // counts).min()))
        if times > 0:
            left[sizes[some]] -= counts.astype(np.int64) * times
            used.append((dict(zip(sizes[some].tolist(), counts.tolist(), strict=True)), times))
    return used


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best fit, largest first, over groups of like sequences: each piece goes where the least
    room is left over.
    """
    groups: dict[int, list[tuple[tuple, int]]] = defaultdict(list)  # gap -> (composition, times)
    for size in np.flatnonzero(left)[::-1].tolist():
        todo = int(left[size])
        for gap in sorted(g for g in groups if g >= size and groups[g]):
            fit, kept = gap // size, []
            for composition, times in groups[gap]:
                if not todo:
                    kept.append((composition, times))
                    continue
                full = min(times, todo // fit)
                if full:
                    groups[gap - fit * size].append(((*composition, (size, fit)), full))
                    todo -= full * fit
                if full < times and todo:  # the last sequence takes what remains
                    groups[gap - todo * size].append(((*composition, (size, todo)), 1))
                    full, todo = full + 1, 0
                if full < times:
                    kept.append((composition, times - full))
            groups[gap] = kept
        if todo:
            fit = capacity // size
            if todo // fit:
                groups[capacity - fit * size].append((((size, fit),), todo // fit))
            if todo % fit:
                groups[capacity - todo % fit * size].append((((size, todo % fit),), 1))
    merged: dict[tuple, int] = defaultdict(int)
    for entries in groups.values():
        for composition, times in entries:
            merged[composition] += times
    return [(dict(composition), times) for composition, times in merged.items()]


def compositions(
    histogram: dict[int, int], capacity: int
) -> tuple[list[tuple[dict[int, int], int]], list[tuple[dict[int, int], int]]]:
    """Compositions and how often each is used: from the linear program, and from best fit."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        left[length] = count
    solved = []
    if left[capacity]:
        solved.append(({capacity: 1}, int(left[capacity])))
        left[capacity] = 0
    lengths, gap, more = np.arange(capacity + 1), GAP, left.any()
    while more:
        more = _rounded(left, capacity, gap)
        solved += more
        if left @ lengths <= capacity * np.count_nonzero(left):
            break
        gap = np.inf  # of the rest, one pass is near enough
    return solved, _best_fit(left, capacity)


def plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Where the pieces of each length go. Rows, by length and first rank: length, first rank,
    first sequence, pieces of the length per sequence, offset of the first of them. The piece of
    rank r is number (r - first rank) in its row, row by row through the sequences.
    """
    solved, rest = compositions(histogram, capacity)
    rows, sequence, rank = [], 0, defaultdict(int)
    for pattern, times in solved + rest:
        offset = 0
        for size in sorted(pattern, reverse=True):
            rows.append((size, rank[size], sequence, pattern[size], offset))
            rank[size] += pattern[size] * times
            offset += pattern[size] * size
        sequence += times
    found = np.array(rows, np.int64).reshape(-1, 5)
    return found[np.lexsort((found[:, 1], found[:, 0]))]


def locate(rows: np.ndarray, lengths: np.ndarray, ranks: np.ndarray):
    """Sequence and offset of pieces by length and rank among their length (from 0)."""
    starts = (rows[:, 0] << 48) + rows[:, 1]
    row = rows[np.searchsorted(starts, (lengths << 48) + ranks, side="right") - 1]
    number = ranks - row[:, 1]
    return row[:, 2] + number // row[:, 3], row[:, 4] + number % row[:, 3] * lengths
