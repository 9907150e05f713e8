"""Deep-shallow sorting of suffixes, as arrays: many small sorts at once.

Suffixes are compared on ``length`` bytes. Up to the shallow depth, multikey quicksort takes eight bytes of all open
groups at a time and parts the groups by them. Groups that still have several members share a long prefix; each becomes
a blind trie. One member is the path of the trie, and all others leave it where they first differ from it: those that
leave at the same place with the same byte form a branch, which is a smaller trie of its own, and those that never leave
are equal to it. Only the bytes where branches part are ever ordered.
"""

from __future__ import annotations

import numpy as np

_COMPARED_AT_ONCE = 1 << 16


def _words(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Eight bytes from each start as one big-endian number, so that numbers compare like bytes."""
    rows = np.lib.stride_tricks.sliding_window_view(data, 8)[starts]
    return np.ascontiguousarray(rows).view(">u8")[:, 0].astype(np.uint64)


def _first_difference(data: np.ndarray, starts: np.ndarray, paths: np.ndarray, depth: int, length: int) -> np.ndarray:
    """Per suffix, the first byte from ``depth`` on where it differs from its path; ``length`` if none does."""
    found = np.empty(len(starts), np.int64)
    view = np.lib.stride_tricks.sliding_window_view(data, length - depth)
    for low in range(0, len(starts), _COMPARED_AT_ONCE):
        part = slice(low, low + _COMPARED_AT_ONCE)
        differs = view[starts[part] + depth] != view[paths[part] + depth]
        first = differs.argmax(axis=1)
        none = ~differs[np.arange(len(first)), first]
        found[part] = np.where(none, length, first + depth)
    return found


def _number(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by the keys (the first one is the most significant), and where runs of equal keys begin and end there."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([key[order][1:] != key[order][:-1] for key in keys])
    begins = np.flatnonzero(new)
    return order, begins, np.append(begins[1:], len(order))


def equal_suffixes(data: np.ndarray, starts: np.ndarray, groups: np.ndarray, length: int, shallow: int = 16) -> np.ndarray:
    """For each suffix the number of the first one (in sort order) of its group that is equal on ``length`` bytes.

    Suffixes of different ``groups`` are never compared. ``data`` has ``length`` bytes from every start on.
    """
    leader = np.arange(len(starts))
    open_, group = leader, groups.astype(np.int64)
    depth = 0
    while depth + 8 <= min(shallow, length) and len(open_):  # multikey quicksort, eight bytes a step
        order, begins, ends = _number(group, _words(data, starts[open_] + depth))
        sizes = ends - begins
        several = np.repeat(sizes > 1, sizes)
        group = np.repeat(np.arange(len(begins)), sizes)[several]
        open_ = open_[order][several]
        depth += 8
    if depth == length:
        order, begins, ends = _number(group)
        leader[open_[order]] = np.repeat(open_[order][begins], ends - begins)
        return leader
    while len(open_):  # blind tries, one path of each at a time
        order, begins, ends = _number(group)
        open_, sizes = open_[order], ends - begins
        path = np.repeat(open_[begins], sizes)
        leaves_at = _first_difference(data, starts[open_], starts[path], depth, length)
        stays = leaves_at == length
        leader[open_[stays]] = path[stays]
        open_, leaves_at = open_[~stays], leaves_at[~stays]
        group = np.repeat(np.arange(len(begins)), sizes)[~stays]
        order, begins, ends = _number(group, leaves_at, data[starts[open_] + leaves_at])
        sizes = ends - begins
        several = np.repeat(sizes > 1, sizes)
        group = np.repeat(np.arange(len(begins)), sizes)[several]
        open_ = open_[order][several]
    return leader
