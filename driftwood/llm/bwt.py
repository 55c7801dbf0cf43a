"""Suffix order, Burrows-Wheeler transform and threshold-bounded interval expansion over a set of byte strings."""

from __future__ import annotations

import numpy as np

#: bits of a rank in a sort key of three ranks
RANK_BITS = 21
#: intervals above this size are extended by searching each byte's places
LARGE = 8192


def prefixes(sym: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, int, int]:
    """For each place its first symbols in one 62-bit key, with 0 after the string's end; how many symbols, and the bits of one."""
    n = len(sym)
    code = np.cumsum(np.bincount(sym, minlength=257) > 0) - 1  # symbols numbered densely
    bits = max(1, int(code[-1]).bit_length())
    left = stop - np.arange(n, dtype=np.int32)  # bytes before the string's end
    key, length = code[sym], 1
    while more := min(length, 62 // bits - length):
        after = np.zeros(n, np.int64)
        after[: max(0, n - length)] = key[length:] >> (bits * (length - more))
        after[left < length] = 0
        key = (key << (bits * more)) | after
        length += more
    return key, length, bits


def _sorted(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys of so many bits, and the keys in order. Where a key and its place fit 63 bits, both are sorted as
    one number, which takes less than half the time of sorting places by key."""
    width = len(key).bit_length()
    if bits + width > 63:
        order = np.argsort(key)
        return order, key[order]
    both = (key << width) | np.arange(len(key))
    both.sort()
    return both & ((1 << width) - 1), both >> width


def suffix_order(sym: np.ndarray, stop: np.ndarray, heads: tuple[np.ndarray, int, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of all suffixes, and the suffixes in order. ``sym``: bytes plus 1, each string ended by a 0;
    ``stop``: for each place the place of its string's end; ``heads``: their prefixes, if at hand.
    Ends count as different symbols, in order of place."""
    n = len(sym)
    width = n.bit_length()
    key, length, bits = heads or prefixes(sym, stop)
    h = max(1, min(length, (63 - width) // bits))
    order, k = _sorted(key >> (bits * (length - h)), bits * h)
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    size = np.diff(np.concatenate([first, [n]]))
    rank = np.empty(n, np.int32)
    rank[order] = np.repeat(first, size)
    ends = np.flatnonzero(sym == 0)
    rank[ends] = np.arange(len(ends))
    open_ = order[np.repeat(size > 1, size)].astype(np.int32)
    open_ = open_[sym[open_] > 0]
    three = width <= RANK_BITS
    while len(open_):
        end = stop[open_]
        key = rank[open_].astype(np.int64)
        for j in (h, 2 * h) if three else (h,):
            key <<= RANK_BITS if three else 31
            key |= rank[np.minimum(open_ + j, end)]
        o = np.argsort(key)
        open_, key = open_[o], key[o]
        group = rank[open_]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        at = np.flatnonzero(new)
        size = np.diff(np.concatenate([at, [len(key)]]))
        head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        base = np.repeat(head, np.diff(np.concatenate([head, [len(key)]])))
        rank[open_] = group + np.repeat(at, size) - base
        open_ = open_[np.repeat(size, size) > 1]
        h *= 3 if three else 2
    sa = np.empty(n, np.int32)
    sa[rank] = np.arange(n, dtype=np.int32)
    return rank, sa


def boundaries(sym: np.ndarray, stop: np.ndarray, rank: np.ndarray, sa: np.ndarray, least: int, heads: tuple[np.ndarray, int, int]) -> np.ndarray:
    """For each pair of neighbours in suffix order whether their common prefix has ``least`` bytes or more.

    Breadth first: the queue holds the intervals of all strings of one length whose end is a boundary that
    was new. Each is extended backward by every byte that stands before its suffixes; the first
    extension to reach a boundary fixes its common prefix at the length of the string extended. Lengths
    rise by one a round and rounds end at ``least``: what is still open then is longer. The strings that the
    keys of ``heads`` hold are the first length, as keys that differ tell how long a prefix they share.
    """
    n = len(sym)
    key, length, bits = heads
    depth = min(length, least)
    k = key[sa] >> (bits * (length - depth))
    apart = k[1:] ^ k[:-1]
    shorter = np.ones(n + 1, bool)  # the common prefix is shorter than ``depth``; where keys are equal one may end
    shorter[1:-1] = (apart != 0) | ((stop[sa] - sa)[1:] < depth)
    open_ = ~shorter
    if depth == least:
        return open_
    edges = np.flatnonzero(shorter)
    lb, rb = edges[:-2].astype(np.int32), edges[1:-1].astype(np.int32)
    # of intervals of this length those whose end is new: the prefix shared there is shorter by one
    new = np.where(apart[rb - 1] != 0, apart[rb - 1] >> bits == 0, (stop[sa[rb]] - sa[rb]) == depth - 1)
    lb, rb = lb[new], rb[new]
    before = sym[sa - 1]  # 0 before the first byte of a string
    back = rank[sa - 1]
    counts = np.bincount(sym, minlength=257)
    start = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    # where the stretch of equal symbols that holds a place ends; the places of the same symbol before and after
    change = np.flatnonzero(np.concatenate([before[1:] != before[:-1], [True]])).astype(np.int32) + 1
    run_end = np.repeat(change, np.diff(np.concatenate([[0], change])))
    by = np.argsort(before, kind="stable").astype(np.int32)
    same = before[by[1:]] == before[by[:-1]]
    earlier, later = np.full(n, -1, np.int32), np.full(n, n, np.int32)
    earlier[by[1:][same]] = by[:-1][same]
    later[by[:-1][same]] = by[1:][same]
    places = {int(c): by[start[c] : start[c + 1]] for c in np.flatnonzero(counts) if c}
    del by, same, change
    for _ in range(depth, least):
        if not len(lb):
            break
        even = run_end[lb] >= rb
        if even.all():
            lb, rb = back[lb], back[rb - 1] + 1
        else:
            next_l, next_r = [back[lb[even]]], [back[rb[even] - 1] + 1]
            lb, rb = lb[~even], rb[~even]
            length = rb - lb
            small = length <= LARGE
            a, b, length = lb[small], rb[small], length[small]
            if len(a):
                # a symbol's first and last place in its interval bound the extension; extensions are disjoint, so
                # in order their starts and ends belong together
                which = np.repeat(np.arange(len(a)), length)
                at = np.arange(len(which)) + (a - np.cumsum(length) + length)[which]
                next_l.append(np.sort(back[at[earlier[at] < a[which]]]))
                next_r.append(np.sort(back[at[later[at] >= b[which]]]) + 1)
            a, b = lb[~small], rb[~small]
            if len(a):
                for c, p in places.items():
                    lo, hi = np.searchsorted(p, a), np.searchsorted(p, b)
                    has = hi > lo
                    next_l.append((start[c] + lo[has]).astype(np.int32))
                    next_r.append((start[c] + hi[has]).astype(np.int32))
            lb, rb = np.concatenate(next_l), np.concatenate(next_r)
        # extensions by a string's end lie before all bytes, where no boundary is open
        new = open_[rb]
        lb, rb = lb[new], rb[new]
        open_[rb] = False
    return open_


def repeated(strings: list[bytes], copies: np.ndarray, least: int) -> list[np.ndarray]:
    """For each string the places where ``least`` bytes start that also start at another place of the strings.
    ``copies``: how often each string occurs (equal strings stand here once)."""
    sizes = np.array([len(s) for s in strings])
    sym = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.uint16) + np.uint16(1)
    stops = np.cumsum(sizes + 1) - 1
    sym[stops] = 0
    stop = np.repeat(stops.astype(np.int32), sizes + 1)
    heads = prefixes(sym, stop)
    rank, sa = suffix_order(sym, stop, heads)
    joined = boundaries(sym, stop, rank, sa, least, heads)[:-1]
    del rank, sym, heads
    group = np.cumsum(~joined) - 1
    long = stop[sa] - sa >= least
    weight = np.bincount(group, np.where(long, np.repeat(copies, sizes + 1)[sa], 0))
    hit = np.zeros(len(sa), bool)
    hit[sa[long & (weight[group] >= 2)]] = True
    return [np.flatnonzero(x) for x in np.split(hit, stops[:-1] + 1)]
