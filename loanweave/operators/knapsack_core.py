"""The part of a selection that prices leave open, solved exactly.

At a price of risk every loan has a surplus: its value less the price of its weight. No choice is worth more than
``price x budget`` plus all positive surpluses, and deciding against the sign of a loan's surplus costs at least that much. So once
a good choice is known, all loans whose surplus is larger than the gap between both are decided; what
is left is the core, a few rows near the end of the budget whatever the number of loans.

The core is solved by states of (weight, value): each row in turn may be decided against its sign, states that weigh
more and are worth no more than another one drop out, and so do those whose bound is not above the best choice so far.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: States of one step and of all steps together up to which a core is solved; beyond, the nearest states go on without a proof.
STATES = 100_000
ALL_STATES = 40_000_000


@dataclass(frozen=True)
class CoreChoice:
    """Places of the chosen rows, their value, and whether no better choice of the core exists."""

    chosen: tuple[int, ...]
    value: int
    proven: bool


def solve_core(values: list[int], weights: list[int], price: float, capacity: int, least: int) -> CoreChoice | None:
    """The most valuable choice of rows within ``capacity`` that is worth more than ``least``, in whole units.

    Without a better choice ``chosen`` is empty and ``value`` is ``least``; None if the sums are too large to be exact.
    """
    if sum(values) + sum(weights) + abs(capacity) + abs(least) >= 2**62:
        return None
    value, weight = np.array(values, np.int64), np.array(weights, np.int64)
    surplus = value - price * weight
    order = np.argsort(np.abs(surplus), kind="stable")
    value, weight, taken = value[order], weight[order], surplus[order] > 0
    step_weight, step_value = np.where(taken, -weight, weight), np.where(taken, -value, value)
    # What can still be given back behind each row.
    removable = np.append(np.cumsum((weight * taken)[::-1])[::-1], 0)
    room, start = capacity - int(weight[taken].sum()), int(value[taken].sum())
    w, v = np.zeros(1, np.int64), np.zeros(1, np.int64)
    best, found, proven, held = least, None, True, 0
    history: list[tuple[np.ndarray, np.ndarray]] = []
    if room >= 0 and start > best:
        best, found = start, (0, 0)
    for k in range(len(value)):
        both_w, both_v = np.concatenate([w, w + step_weight[k]]), np.concatenate([v, v + step_value[k]])
        parent = np.tile(np.arange(len(w), dtype=np.int32), 2)
        against = np.arange(len(both_w)) >= len(w)
        by = np.lexsort((-both_v, both_w))
        both_w, both_v, parent, against = both_w[by], both_v[by], parent[by], against[by]
        top = np.maximum.accumulate(both_v)
        keep = np.append(True, both_v[1:] > top[:-1]) & (both_w - removable[k + 1] <= room)
        # The bound of a state is what it is worth if the room that is left sells at the price. Values are whole, so it has to be
        # one unit above the best choice; a margin covers rounding.
        bound = (start - best) + both_v + price * (room - both_w)
        keep &= bound > 1 - 1e-6 - 1e-14 * (np.abs(both_v) + price * np.abs(both_w) + price * abs(room) + abs(start - best))
        at = np.flatnonzero(keep)
        if len(at) > STATES:
            proven = False
            at = np.sort(at[np.argsort(np.abs(room - both_w[at]), kind="stable")[:STATES]])
        w, v = both_w[at], both_v[at]
        history.append((parent[at], against[at]))
        held += len(at)
        if not len(at):
            break
        fits = np.flatnonzero(w <= room)
        if len(fits) and start + int(v[fits[-1]]) > best:
            # Values rise with weights.
            best, found = start + int(v[fits[-1]]), (k + 1, int(fits[-1]))
        if held > ALL_STATES:
            proven = False
            break
    if found is None:
        return CoreChoice((), least, proven)
    steps, state = found
    choice = taken.copy()
    for k in range(steps - 1, -1, -1):
        parent, against = history[k]
        choice[k] ^= bool(against[state])
        state = int(parent[state])
    return CoreChoice(tuple(sorted(order[choice].tolist())), best, proven)
