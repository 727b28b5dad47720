"""Packing counts of lengths by a configuration linear program.

A configuration is a multiset of lengths that fits a sequence.  The program asks for the fewest
sequences, in fractions of configurations, that cover every length's count.  It is solved
by multiplicative weights, with a knapsack dynamic program as the pricing step, and then rounded.

*Rows.*  Pieces of at most a sixteenth of the capacity fill any room, so they are one row of unit pieces.  Of the
rest, every length is a row as long as there are few; beyond that neighbouring lengths share a row, counted as its
longest, of a bounded share of the tokens.  So the cost depends on the capacity and not on the corpus.

*Weights.*  The program is a game: lengths choose weights (their prices), configurations choose
shares.  Each round plays a fixed number of steps on a pool of configurations: a row's weight is multiplied by exp(-rate x how much
it is covered too much), a configuration's share by exp(rate x how much its contents are worth too much), with the last
loss counted twice and the one before taken off again (optimistic steps).  Losses stay within -1 and 1.  The steps' averages are the
round's shares and weights.  Then the knapsack prices all configurations by the average weights: the dearest one and, for
each length, the dearest that holds it, join the pool, and those of no share leave it.

*Bound.*  Prices scaled so that the dearest configuration is worth 1 are a solution of the dual, so
what all pieces are worth is a lower bound.  Rounds end at a gap of 0.05 % on the rows, or at their number;
``lower_bound`` prices the lengths as they are, and so holds for any packing.

*Rounding.*  A part of the cover is made whole and the rest is packed best-fit, also into the room that
configurations leave; of a few such parts, from all to a twentieth, the one with the fewest sequences is kept.  Shares are
rounded by running sums in the order of the configurations, so what one has too few of its neighbour has too
much of.  Configurations take their pieces but for the shortest one, whose room best-fit fills with the length that fits it best.
"""

from __future__ import annotations

import bisect
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate

import numpy as np

Bins = list[tuple[list[tuple[int, int]], int]]   # ([(length, uses)], number of such sequences)

SMALL = 16        # a piece of at most capacity / SMALL fills rooms
ROWS = 400        # rows of their own up to here; beyond it a row has this part of the tokens
RATE = 0.4
STEPS, ROUNDS, GAP = 400, 64, 5e-4
NEAR, POOL = 0.02, 3000
PARTS = (1, 0.997, 0.99, 0.98, 0.96, 0.92, 0.85, 0.7, 0.5, 0.3, 0.15, 0.05)


@dataclass
class Rows:
    """The program's rows: ``lengths[i]`` (ascending) count as ``size[i]``, their longest; ``need[i]`` pieces; tokens of small ones."""
    lengths: list[list[int]]
    size: np.ndarray
    need: np.ndarray
    small: int


@dataclass
class Cover:
    """``columns``: [(((row, uses), ...), x)], fractions of configurations that cover every row's need; ``value``: their sum;
    ``bound``: no cover has less; ``price`` of each row and ``unit`` of a token of small pieces, which show it."""
    columns: list[tuple[tuple[tuple[int, int], ...], float]]
    value: float
    bound: float
    price: np.ndarray
    unit: float


def rows_of(hist: dict[int, int], capacity: int, rows: int = ROWS) -> Rows:
    large = sorted(n for n in hist if n > capacity // SMALL)
    groups: list[list[int]] = [[n] for n in large]
    if len(large) > rows:
        share = sum(n * hist[n] for n in large) / rows
        groups, held = [], 0.0
        for n in reversed(large):
            if not groups or held + n * hist[n] > share:
                groups.append([])
                held = 0.0
            groups[-1].append(n)
            held += n * hist[n]
        groups = [g[::-1] for g in reversed(groups)]
    return Rows(groups, np.array([g[-1] for g in groups], np.int64),
                np.array([sum(hist[n] for n in g) for g in groups], float),
                sum(n * c for n, c in hist.items() if n <= capacity // SMALL))


def knapsack(size: np.ndarray, price: np.ndarray, unit: float, capacity: int) -> tuple[np.ndarray, list[int]]:
    """The dearest contents within each room 0..capacity, any number of each size (ascending), ``unit`` for a token of
    small pieces: (worth, a size's index that is in it, or -1 for a token)."""
    worth = np.zeros(capacity + 1)
    choice = [-1] * (capacity + 1)
    fit = np.searchsorted(size, np.arange(capacity + 1), side="right").tolist()
    for w in range(1, capacity + 1):
        best = worth[w - 1] + unit
        if fit[w]:
            with_one = worth[w - size[:fit[w]]] + price[:fit[w]]
            i = int(with_one.argmax())
            if with_one[i] > best + 1e-15:
                best, choice[w] = with_one[i], i
        worth[w] = best
    return worth, choice


def contents(room: int, choice: list[int], size: np.ndarray) -> Counter:
    """{row: uses} of the dearest contents of ``room``."""
    out: Counter = Counter()
    while room:
        i = choice[room]
        if i < 0:
            room -= 1
        else:
            out[i] += 1
            room -= int(size[i])
    return out


class _Pool:
    """Configurations ((row, uses), ...) and their matrix: entry = covered share of a row's need, at the size bound's number of sequences."""

    def __init__(self, rows: Rows, capacity: int, scale: np.ndarray):
        self.rows, self.capacity, self.scale = rows, capacity, scale
        self.at: dict[tuple, int] = {}

    def add(self, config: Counter) -> bool:
        new = len(self.at)
        return self.at.setdefault(tuple(sorted(config.items())), new) == new

    def keep(self, held: np.ndarray) -> None:
        self.at = {c: i for i, c in enumerate(c for c, h in zip(self.at, held.tolist(), strict=True) if h)}

    def matrix(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, col, uses = [], [], []
        for c, j in self.at.items():
            room = self.capacity - sum(k * int(self.rows.size[i]) for i, k in c)
            for i, k in (*c, *([(len(self.rows.size), room)] if self.rows.small else [])):
                row.append(i)
                col.append(j)
                uses.append(k)
        row = np.array(row, np.int64)
        return row, np.array(col, np.int64), np.array(uses) * self.scale[row]


def cover(rows: Rows, capacity: int, rounds: int = ROUNDS, steps: int = STEPS, gap: float = GAP) -> Cover:
    """The fractional cover and its bound, by multiplicative weights on a growing pool of configurations."""
    size, g = rows.size, len(rows.size)
    tokens = float(size @ rows.need + rows.small)
    if not tokens:
        return Cover([], 0.0, 0.0, np.zeros(0), 0.0)
    ideal = tokens / capacity
    need = np.r_[rows.need, [rows.small] if rows.small else []]
    weight = np.r_[size * rows.need, [rows.small] if rows.small else []] / tokens   # every token is worth the same
    scale = ideal / need
    per = np.r_[capacity // size, [capacity] if rows.small else []]
    pool, share = _Pool(rows, capacity, scale), []
    for pattern, uses in best_fit(dict(zip(size.tolist(), rows.need.astype(int).tolist(), strict=True)), capacity):
        pool.add(Counter({int(np.searchsorted(size, n)): k for n, k in pattern}))
        share += [0.0] * (len(pool.at) - len(share))
        share[-1] += uses
    for i in range(g):
        pool.add(Counter({i: int(per[i])}))
    if rows.small:
        pool.add(Counter())
    share = np.r_[share, np.zeros(len(pool.at) - len(share))]
    share = share + 0.01 * share.sum() / len(share) + 1e-9
    share /= share.sum()
    best, value, bound, known = [], np.inf, 0.0, weight * scale

    for r in range(rounds + 1):
        price = weight * scale
        worth, choice = knapsack(size, price[:g], price[g] if rows.small else 0.0, capacity)
        if ideal / worth[-1] > bound:      # weights sum to 1, so all pieces are worth `ideal`
            bound, known = ideal / worth[-1], price
        if value <= bound * (1 + gap) or r == rounds:
            break
        if len(share) > POOL:
            held = share >= np.sort(share)[-POOL // 2]
            pool.keep(held)
            share = share[held]
        pool.add(contents(capacity, choice, size))
        holds = price[:g] + worth[capacity - size]
        for i in np.flatnonzero(holds >= worth[-1] * (1 - NEAR)).tolist():
            pool.add(contents(capacity - int(size[i]), choice, size) + Counter({i: 1}))
        new = len(pool.at) - len(share)
        share = np.r_[share / share.sum(), np.full(new, 0.02 / max(new, 1))]
        share, weight = _play(*pool.matrix(), np.log(share), np.log(np.maximum(weight, 1e-300)), steps)

        row, col, part = pool.matrix()
        covered = np.bincount(row, part * share[col], len(need))
        for level in np.unique(np.quantile(covered[covered > 0], np.linspace(0, 0.5, 17))):   # what the average lacks goes alone
            lack = np.maximum(1 - covered / level, 0) * need / per
            if (v := ideal / level + lack.sum()) < value:
                value = v
                alone = [(((i, int(per[i])),) if i < g else (), lack[i]) for i in np.flatnonzero(lack).tolist()]
                best = [(c, x) for c, x in zip(pool.at, (share * ideal / level).tolist(), strict=True)] + alone
    return Cover(best, value, bound, known[:g], known[g] if rows.small else 0.0)


def lower_bound(hist: dict[int, int], rows: Rows, found: Cover, capacity: int) -> float:
    """No packing of ``hist`` has fewer sequences: the cover's prices for the lengths themselves, between rows in proportion."""
    n = np.array(sorted(n for n, c in hist.items() if c), np.int64)
    if not len(n):
        return 0.0
    count = np.array([hist[x] for x in n.tolist()], float)
    large = n > capacity // SMALL
    bounds = [float(n @ count / capacity)]
    if len(rows.size):
        down = np.r_[0, found.price][np.searchsorted(rows.size, n, side="right")]   # as the next shorter row
        for of_row in (np.interp(n, rows.size, found.price), down):
            price = np.where(large, of_row, n * found.unit)
            worth, _ = knapsack(n[large], price[large], found.unit, capacity)
            bounds.append(float(price @ count / worth[-1]))
    return max(bounds)


def _play(row, col, part, log_share, log_weight, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Optimistic multiplicative-weights steps from these shares and weights; their averages, later steps counting more."""
    n, m = len(log_share), len(log_weight)
    shares, weights = np.zeros(n), np.zeros(m)
    last_over = last_worth = None
    for t in range(1, steps + 1):
        weight = np.exp(log_weight - log_weight.max())
        share = np.exp(log_share - log_share.max())
        weight /= weight.sum()
        share /= share.sum()
        shares += t * share
        weights += t * weight
        covered = np.bincount(row, part * share[col], m)
        over = (covered - 1) / np.maximum(covered, 1)
        worth = np.bincount(col, part * weight[row], n) - 1
        log_weight = log_weight - RATE * (2 * over - (over if last_over is None else last_over))
        log_share = log_share + RATE * (2 * worth - (worth if last_worth is None else last_worth))
        last_over, last_worth = over, worth
    return shares / shares.sum(), weights / weights.sum()


def best_fit(hist: dict[int, int], capacity: int, begun=()) -> Bins:
    """Best-fit decreasing on counts: ``[([(length, uses)], bins)]``.  Bins alike are one class.

    ``begun`` are bins that hold something already.
    """
    classes: dict[int, list] = {}   # room -> [(pattern, bins)]
    rooms: list[int] = []
    done = []

    def put(room, pattern, bins):
        if not bins:
            return
        if room == 0:
            done.append((pattern, bins))
            return
        if room not in classes:
            classes[room] = []
            bisect.insort(rooms, room)
        classes[room].append((pattern, bins))

    def take(room):
        got = classes[room].pop()
        if not classes[room]:
            del classes[room]
            rooms.pop(bisect.bisect_left(rooms, room))
        return got

    for pattern, bins in begun:
        put(capacity - sum(n * k for n, k in pattern), pattern, bins)
    for n in sorted(hist, reverse=True):
        count = hist[n]
        while count:
            at = bisect.bisect_left(rooms, n)
            if at == len(rooms):
                per = capacity // n
                put(capacity - per * n, [(n, per)], count // per)
                if count % per:
                    put(capacity - (count % per) * n, [(n, count % per)], 1)
                break
            room = rooms[at]
            pattern, bins = take(room)
            per = room // n
            full = min(bins, count // per)
            put(room - per * n, [*pattern, (n, per)], full)
            count -= full * per
            rest = bins - full
            if rest and count:  # fewer than `per` are left
                put(room - count * n, [*pattern, (n, count)], 1)
                rest, count = rest - 1, 0
            put(room, pattern, rest)
    return done + [c for v in classes.values() for c in v]


def _drawn(queue: list[list[int]], count: int) -> list[tuple[int, int]]:
    """Up to ``count`` pieces off a row's queue of [length, pieces], as runs (length, pieces)."""
    runs = []
    while count and queue:
        n, c = queue[-1]
        k = min(c, count)
        runs.append((n, k))
        count -= k
        if k == c:
            queue.pop()
        else:
            queue[-1][1] -= k
    return runs


def _begun(rows: Rows, hist: dict[int, int], columns, part: float) -> tuple[Bins, dict[int, int]]:
    """A part of the cover, rounded, with its pieces in it, and what is left."""
    queues = [[[n, hist[n]] for n in lengths] for lengths in rows.lengths]
    bins: Bins = []
    total, before = 0.0, 0
    for config, x in columns:
        total += x * part
        uses, before = int(total + 0.5) - before, int(total + 0.5)
        slots = [i for i, k in config for _ in range(k)]   # longest first
        slots = [_drawn(queues[i], uses) for i in slots[:max(len(slots) - 1, 1)]]   # one piece of each bin at a time
        ends = sorted({e for runs in slots for e in np.cumsum([c for _, c in runs]).tolist()})
        first = 0
        for end in ends:      # the bins between two ends hold the same lengths
            held: Counter = Counter()
            for runs in slots:
                at = 0
                for n, c in runs:
                    at += c
                    if first < at:
                        held[n] += 1
                        break
            bins.append((sorted(held.items(), reverse=True), end - first))
            first = end
    large = {n for lengths in rows.lengths for n in lengths}
    left = {n: c for n, c in hist.items() if n not in large}
    left.update({n: c for queue in queues for n, c in queue})
    return bins, left


def plan(hist: dict[int, int], capacity: int, **lp) -> Bins:
    """Whole uses of configurations that hold every piece of ``{length: count}``: the rounded cover, the rest best-fit."""
    hist = {n: c for n, c in hist.items() if c}
    rows = rows_of(hist, capacity)
    tokens = sum(n * c for n, c in hist.items())
    found = sorted(cover(rows, capacity, **lp).columns, key=lambda c: c[1])
    tiny = bisect.bisect_right(list(accumulate(x for _, x in found)), max(0.5, 2e-4 * tokens / capacity))   # next to nothing together
    columns = sorted((sorted(c, reverse=True), x) for c, x in found[tiny:])[::-1]
    least = -(-tokens // capacity)
    best, fewest = [], None
    for part in PARTS:
        bins, left = _begun(rows, hist, columns, part)
        bins = best_fit(left, capacity, bins)
        count = sum(uses for _, uses in bins)
        if fewest is None or count < fewest:
            best, fewest = bins, count
        if count == least:
            break
    return best
