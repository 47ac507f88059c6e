"""Vectorised kernel of the anchored duplicate window.

A window opens at a row and holds the following rows of its group until one lies
at least ``width`` milliseconds after the opening row; that one opens the next.
Only a row later than all before it can open a window, so windows follow from
the running maximum of the times, which is sorted and can be searched.
"""

from __future__ import annotations

import numpy as np

SLICE = 8192


def fold(groups, micros, width, carry=None, more=None):
    """Window start and ordinal of each row.

    ``groups`` are non-decreasing group numbers starting at 0, ``micros`` the event
    times in arrival order, ``carry`` the ``(window_start, ordinal)`` reached by
    group 0 before these rows, or None.  A row that stands for several, all of them in
    its window, has the others in ``more``; only the first row of a group may.
    """
    more = np.zeros(len(micros), np.int64) if more is None else more
    starts = np.empty(len(micros), np.int64)
    ordinals = np.empty(len(micros), np.int64)
    for lo in range(0, len(micros), SLICE):
        hi = min(lo + SLICE, len(micros))
        if lo and groups[lo] != groups[lo - 1]:
            carry = None
        part = groups[lo:hi] - groups[lo]
        starts[lo:hi], ordinals[lo:hi] = _fold_slice(part, micros[lo:hi], width, carry, more[lo:hi])
        carry = (int(starts[hi - 1]), int(ordinals[hi - 1]))
    return starts, ordinals


def _fold_slice(groups, micros, width, carry, more):
    size = len(micros)
    millis = micros // 1000
    low = int(millis.min())
    # one sorted key for all groups: the span of a group, then the time inside it
    span = int(millis.max()) - low + width + 1
    reached = np.maximum.accumulate(groups * span + (millis - low))
    rows = np.arange(size)
    heads = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
    ends = np.append(heads[1:], size)
    current = heads
    if carry is not None:
        due = carry[0] // 1000 + width - low
        first = int(np.searchsorted(reached[: ends[0]], max(due, 0), "left"))
        current = heads[1:] if first >= ends[0] else np.concatenate(([first], heads[1:]))
    opens = np.zeros(size, bool)
    while len(current):
        opens[current] = True
        following = np.searchsorted(reached, reached[current] + width, "left")
        current = following[following < ends[groups[current]]]
    opener = np.maximum.accumulate(np.where(opens, rows, -1))
    inherited = opener < 0
    starts = micros[np.where(inherited, 0, opener)]
    ordinals = rows - opener + 1 + more[np.maximum(opener, 0)]
    if carry is not None:
        starts = np.where(inherited, carry[0], starts)
        ordinals = np.where(inherited, carry[1] + rows + 1, ordinals)
    return starts, ordinals


def exits(micros, positions, total, width, latest):
    """What a run of one group turns an unknown incoming window into.

    ``micros`` and ``positions`` describe the rows that exceed all earlier rows of
    the run, ``total`` is its row count, ``latest`` the largest millisecond seen
    before it.  Returns ``(entry_millis, window_start, ordinal)``: an incoming
    window due at ``x`` leaves the run as told by the first entry at or after ``x``.
    """
    millis = micros // 1000
    count = len(millis)
    following = np.searchsorted(millis, millis + width, "left")
    last = np.where(following < count, following, np.arange(count))
    while True:
        further = last[last]
        if np.array_equal(further, last):
            break
        last = further
    reachable = min(count, int(np.searchsorted(millis, latest + width, "left")) + 1)
    last = last[:reachable]
    keep = np.append(last[1:] != last[:-1], True) if reachable else np.zeros(0, bool)
    return millis[:reachable][keep], micros[last][keep], (total - positions[last])[keep]
