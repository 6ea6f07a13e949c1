"""One family's fit: weighted least squares under sums and bounds, and its controlled rounding.

A family is a parent with its children's cells. Spark brings each family's rows together; inside a task its cells
are numpy arrays, and a group of cells (a query level of a child, a cell over all children) is an integer label per cell,
-1 for none. Both helpers are linear in the cells but for the number of rounds or cycles.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Units that an integer is cut into while rounding, so that sums stay exact; so many count as nothing.
UNIT, NOTHING = 1 << 32, 1 << 12


@dataclass
class Soft:
    """A noisy sum of every group: its answer and variance."""

    group: np.ndarray
    answer: np.ndarray
    variance: np.ndarray


@dataclass
class Hard:
    """Least and most sum of every group (infinite: none)."""

    group: np.ndarray
    low: np.ndarray
    high: np.ndarray


def numbered(*labels) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each row by its labels (-1 where one is missing), and the first row of each group."""
    known: dict = {}
    out, first = np.empty(len(labels[0]), np.int64), []
    for k, key in enumerate(zip(*labels, strict=True)):
        if any(x is None or x != x for x in key):
            out[k] = -1
            continue
        if key not in known:
            known[key] = len(known)
            first.append(k)
        out[k] = known[key]
    return out, np.array(first, np.int64)


def _sums(group: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    inside = group >= 0
    return np.bincount(group[inside], x[inside], n)[:n]


def _at(value: np.ndarray, group: np.ndarray) -> np.ndarray:
    return np.where(group >= 0, value[group], 0.0) if len(value) else np.zeros(len(group))


def fit(x: np.ndarray, variance: np.ndarray, sums: Hard, soft: list[Soft], hard: list[Hard], tol: float = 1e-8, rounds: int = 20_000) -> tuple[np.ndarray, float]:
    """Nearest x (weights 1 / variance) that is not negative, keeps sums and hard, and is drawn to soft; and what is left of violations.

    Projections on one set after the other with correction terms (Dykstra): for a bound one per group, for x >= 0 one per cell,
    for equations none. An answer is a further variable beside its group's sum. The residual (largest violation,
    largest move of a round) stops it. If bounds contradict each other it ends with the sums and x >= 0 kept, residual above tol.
    """
    x, weight = x.astype(float).copy(), variance.astype(float)
    bounds = [sums, *hard]
    spread = [_sums(h.group, weight, len(h.low)) for h in bounds]
    moved = [np.zeros(len(h.low)) for h in bounds]
    answer = [s.answer.astype(float).copy() for s in soft]
    around = [_sums(s.group, weight, len(s.answer)) + s.variance for s in soft]
    below = np.zeros(len(x))
    residual = np.inf
    for k in range(rounds):
        before = x
        for i, s in enumerate(soft):
            share = (_sums(s.group, x, len(answer[i])) - answer[i]) / around[i]
            x = x - weight * _at(share, s.group)
            answer[i] = answer[i] + s.variance * share
        for i in [*range(1, len(bounds)), 0]:
            h = bounds[i]
            x = x + weight * _at(moved[i], h.group)
            total = _sums(h.group, x, len(h.low))
            moved[i] = (total - np.clip(total, h.low, h.high)) / np.maximum(spread[i], 1e-300)
            x = x - weight * _at(moved[i], h.group)
        x = x + below
        below = np.minimum(x, 0.0)
        x = x - below
        if k % 10 == 9 or k == rounds - 1:
            off = [np.abs(t - np.clip(t, h.low, h.high)).max(initial=0.0) for h in bounds for t in [_sums(h.group, x, len(h.low))]]
            residual = max(*off, np.abs(x - before).max(initial=0.0))
            if residual <= tol:
                return x, residual
    return _simplex(x, sums), residual


def _simplex(x: np.ndarray, sums: Hard) -> np.ndarray:
    """Not negative, with the sums that are equations met: what is missing is scaled or spread."""
    x = np.maximum(x, 0.0)
    total, n = _sums(sums.group, x, len(sums.low)), _sums(sums.group, np.ones(len(x)), len(sums.low))
    fixed = sums.low == sums.high
    factor = np.where(fixed & (total > 0), sums.low / np.maximum(total, 1e-300), 1.0)
    extra = np.where(fixed & (total <= 0), sums.low / np.maximum(n, 1), 0.0)
    return np.where(sums.group >= 0, x * np.where(sums.group >= 0, factor[sums.group], 1.0) + _at(extra, sums.group), x) if len(factor) else x


def controlled_round(x: np.ndarray, column: np.ndarray, total: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Integers next to x whose column sums are total and whose level sums stay next to the real ones, as near to x as can be.

    levels: nested group numbers from coarse to fine. x, columns and levels are a flow: level -> finer level -> cell ->
    column. As long as an edge is fractional it lies on a cycle of such edges; moving units along the cycle, up on
    one half and down on the other, keeps all sums and makes an edge whole. The direction is the one that brings cells
    nearer; at the end cycles that would still bring the sum of |x - integer| down are turned too.
    """
    units = np.rint(x * UNIT).astype(np.int64)
    for c, t in enumerate(total):
        rows = np.flatnonzero(column == c)
        if len(rows):
            units[rows[np.argmax(units[rows])]] += int(t) * UNIT - units[rows].sum()
    node = np.zeros(len(x), np.int64)  # 0: everything outside; the innermost level of a cell so far
    ends: list[tuple[int, int]] = []
    flow: list[int] = []
    nodes = 1
    for group in levels:
        inside = np.flatnonzero(group >= 0)
        of: dict[int, int] = {}
        amount: dict[int, int] = {}
        for r in inside.tolist():
            g = int(group[r])
            if of.setdefault(g, int(node[r])) != node[r]:
                raise ValueError("levels are not nested")
            amount[g] = amount.get(g, 0) + int(units[r])
        number = {g: nodes + i for i, g in enumerate(of)}
        nodes += len(of)
        for g, up in of.items():
            ends.append((up, number[g]))
            flow.append(amount[g])
        for r in inside.tolist():
            node[r] = number[int(group[r])]
    first = len(ends)
    for r in range(len(x)):
        ends.append((int(node[r]), nodes + int(column[r]) if column[r] >= 0 else 0))
        flow.append(int(units[r]))
    near = NOTHING + len(x)
    part = [0 if (p := f % UNIT) <= near else UNIT if p >= UNIT - near else p for f in flow]  # a sum that is whole stays so
    cost = [0] * first + [UNIT - 2 * p for p in part[first:]]
    broken = [e for e, p in enumerate(part) if p % UNIT]
    open_ = [e for e in broken if ends[e][0] != ends[e][1]]
    loops = [e for e in broken if ends[e][0] == ends[e][1]]  # bound by nothing
    for e in loops:
        part[e] = UNIT if 2 * part[e] >= UNIT else 0
    _whole(ends, part, cost, open_)
    _turn(ends, part, cost, open_, nodes + len(total))
    return np.array([f // UNIT + (p == UNIT) for f, p in zip(flow[first:], part[first:], strict=True)], np.int64)


def _whole(ends: list[tuple[int, int]], part: list[int], cost: list[int], open_: list[int]) -> None:
    """Cancel cycles of fractional edges until none is left."""
    at: dict[int, set[int]] = {}
    for e in open_:
        for n in ends[e]:
            at.setdefault(n, set()).add(e)

    def shut(e: int) -> None:
        for n in ends[e]:
            at[n].discard(e)

    for start in list(at):
        path, where, here = [], {start: 0}, start  # edges walked, and at which step each node was met
        while True:
            last = path[-1] if path else -1
            e = next((e for e in at[here] if e != last), None)
            if e is None:
                if not path:
                    break
                if abs(2 * part[last] - UNIT) < UNIT // 2:
                    raise ArithmeticError("a sum is not whole")
                part[last] = UNIT if 2 * part[last] > UNIT else 0  # what is left of values that count as nothing
                shut(last)
                del where[here]
                path.pop()
                here = next(n for n in ends[last] if n != here)
                continue
            there = ends[e][0] if ends[e][1] == here else ends[e][1]
            path.append(e)
            if there not in where:
                where[there] = len(path)
                here = there
                continue
            cycle, n, signs = path[where[there] :], there, []
            for c in cycle:  # +1 where the cycle runs along the edge
                signs.append(1 if ends[c][0] == n else -1)
                n = ends[c][1] if signs[-1] == 1 else ends[c][0]
            if sum(s * cost[c] for s, c in zip(signs, cycle, strict=True)) > 0:
                signs = [-s for s in signs]
            step = min(UNIT - part[c] if s == 1 else part[c] for s, c in zip(signs, cycle, strict=True))
            for s, c in zip(signs, cycle, strict=True):
                part[c] += s * step
                if part[c] <= NOTHING or part[c] >= UNIT - NOTHING:
                    part[c] = UNIT if part[c] > NOTHING else 0
                    shut(c)
            keep = next(k for k, c in enumerate(path) if k >= where[there] and part[c] in (0, UNIT))
            path = path[:keep]
            where = {n: k for n, k in where.items() if k <= keep}
            here = next(n for n, k in where.items() if k == keep)


def _turn(ends: list[tuple[int, int]], part: list[int], cost: list[int], open_: list[int], nodes: int) -> None:
    """Turn cycles of negative cost among the edges that may still go up or down by one."""
    if not open_:
        return
    edge = np.array(open_)
    a, b = np.array([ends[e] for e in open_]).T
    price = np.array([cost[e] for e in open_])
    while True:
        up = np.array([part[e] == 0 for e in open_])
        frm, to, w = np.where(up, a, b), np.where(up, b, a), np.where(up, price, -price)
        order = np.argsort(to, kind="stable")
        heads = np.flatnonzero(np.r_[True, np.diff(to[order]) > 0])
        dist, pred = np.zeros(nodes, np.int64), np.full(nodes, -1)
        found = None
        for k in range(nodes + 1):
            through = (dist[frm] + w)[order]
            best = np.minimum.reduceat(through, heads)
            pick = _first(through, best, heads)
            node = to[order][heads]
            better = best < dist[node]
            if not better.any():
                return
            dist[node[better]] = best[better]
            pred[node[better]] = order[pick[better]]
            if k % 8 == 7 or k >= nodes:
                found = _cycle(pred, frm)
                if found:
                    break
        for e in found:
            part[edge[e]] = UNIT - part[edge[e]]


def _first(through: np.ndarray, best: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Place of the first least value of every run."""
    size = np.diff(np.r_[heads, len(through)])
    hit = np.where(through == np.repeat(best, size), np.arange(len(through)), len(through))
    return np.minimum.reduceat(hit, heads)


def _cycle(pred: np.ndarray, frm: np.ndarray) -> list[int] | None:
    """Edges of a cycle in the tree of predecessors, if there is one."""
    seen = np.zeros(len(pred), np.int64)
    for start in range(len(pred)):
        n, walk = start, start + 1
        while pred[n] >= 0 and not seen[n]:
            seen[n] = walk
            n = frm[pred[n]]
        if pred[n] >= 0 and seen[n] == walk:
            out, m = [], n
            while True:
                out.append(int(pred[m]))
                m = frm[pred[m]]
                if m == n:
                    return out
    return None
