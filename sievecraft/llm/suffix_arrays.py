"""Suffix arrays by induced sorting, and permuted common prefixes, of the strings of one shard."""

from __future__ import annotations

import numpy as np


def _suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one. The end of the text is smaller than all."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int32), append=-1))
    place = np.where(step != 0, np.arange(n), n - 1)
    following = np.minimum.accumulate(place[::-1])[::-1]
    return step[following] > 0


def _names(text: np.ndarray, smaller: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Names of the substrings from each of `starts` to the next one, in lexicographic order.

    Symbols carry their type in the lowest bit, so no substring is a prefix of another.
    """
    n, per, bits = len(text), 6, 10
    symbols = np.zeros(n + 1 + per, np.int64)
    symbols[:n] = text.astype(np.int64) * 2 + smaller + 1
    sizes = np.append(starts[1:], n) - starts + 1

    def column(rows: np.ndarray, base: int) -> np.ndarray:
        key = np.zeros(len(rows), np.int64)
        for k in range(base, base + per):
            there = np.minimum(starts[rows] + k, n)
            key = (key << bits) | np.where(k < sizes[rows], symbols[there], 0)
        return key

    _, name, count = np.unique(column(np.arange(len(starts)), 0), return_inverse=True, return_counts=True)
    name = (np.cumsum(count) - count)[name]  # a name is the first place of its group
    base = per
    rows = np.flatnonzero(sizes > base)
    while len(rows):
        key = column(rows, base)
        order = np.lexsort((key, name[rows]))
        rows, key = rows[order], key[order]
        group = np.append(True, name[rows][1:] != name[rows][:-1])
        fresh = group | np.append(True, key[1:] != key[:-1])
        at = np.arange(len(rows))
        offset = np.maximum.accumulate(np.where(fresh, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        name[rows] += offset
        base += per
        rows = rows[sizes[rows] > base]
    return name


def _order_of_names(name: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a sequence of names: names of pairs, of fours, and so on, for those that are still alike."""
    n = len(name)
    rank, reach = name.astype(np.int64) + 1, 1  # first place of the group, from 1
    rows = np.flatnonzero(np.bincount(rank)[rank] > 1)
    while len(rows):
        next_ = rows + reach
        key = rank[rows] * (n + 1) + np.where(next_ < n, rank[np.minimum(next_, n - 1)], 0)
        order = np.argsort(key)
        rows, key = rows[order], key[order]
        own = rank[rows]
        group = np.append(True, own[1:] != own[:-1])
        fresh = np.append(True, key[1:] != key[:-1])
        at = np.arange(len(rows))
        first = np.maximum.accumulate(np.where(fresh, at, 0))
        rank[rows] = own + first - np.maximum.accumulate(np.where(group, at, 0))
        alone = fresh & np.append(fresh[1:], True)
        rows, reach = rows[~alone], reach * 2
    return np.argsort(rank)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of a text of small numbers, in lexicographic order.

    Suffixes are classified; the leftmost smaller ones are sorted by their names; from them the larger ones are induced
    bucket by bucket from the left, and from these the smaller ones from the right. Each pass is linear.
    """
    n = len(text)
    if n < 2:
        return np.arange(n)
    smaller = _suffix_types(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(lms):
        lms = lms[_order_of_names(_names(text, smaller, lms))]
    counts = np.bincount(text)
    ends = np.cumsum(counts)
    heads, tails = ends - counts, ends.copy()
    out = np.full(n, -1, np.int64)

    symbols = text[lms]
    own = np.bincount(symbols, minlength=len(counts))
    order = np.argsort(symbols, kind="stable")
    out[(ends - own)[symbols[order]] + np.arange(len(order)) - np.repeat(np.cumsum(own) - own, own)] = lms[order]

    def place(block: np.ndarray, edge: np.ndarray, larger: bool) -> None:
        """Puts the left neighbours of a block, in its order, at the edges of their buckets."""
        left = block[block > 0] - 1
        left = left[smaller[left] != larger]
        if not len(left):
            return
        symbol = text[left]
        order = np.argsort(symbol, kind="stable")
        symbol, left = symbol[order], left[order]
        many = np.bincount(symbol, minlength=len(counts))
        inside = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many)
        if larger:
            out[edge[symbol] + inside] = left
            edge += many
        else:
            out[edge[symbol] - 1 - inside] = left
            edge -= many

    place(np.array([n]), heads, True)
    for c in np.flatnonzero(counts).tolist():
        at = ends[c] - counts[c]
        while at < heads[c]:
            to = heads[c]
            place(out[at:to], heads, True)
            at = to
        if own[c]:
            place(out[ends[c] - own[c] : ends[c]], heads, True)
    for c in np.flatnonzero(counts)[::-1].tolist():
        at = ends[c]
        while tails[c] < at:
            to = tails[c]
            place(out[to:at][::-1], tails, False)
            at = to
        place(out[ends[c] - counts[c] : heads[c]][::-1], tails, False)
    return out


def common_prefixes(data: np.ndarray, text: np.ndarray, array: np.ndarray, end: np.ndarray):
    """Longest common prefix of each suffix with the one before it in the array, in text order; and that one's start.

    data: the bytes, eight more at the end. end: for each place, where its string ends; prefixes stop there. Only where
    the letters to the left of both differ a prefix is measured; elsewhere it is that of the left neighbour less one.
    """
    n = len(array)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    place = np.arange(n)
    there = np.maximum(before, 0)
    measured = (before <= 0) | (place == 0)
    measured |= text[place - 1] != text[there - 1]
    measured |= text[place - 1] == 0
    rows = np.flatnonzero(measured & (before >= 0))
    limit = np.minimum(end[rows] - rows, end[before[rows]] - before[rows])
    eights = np.ndarray((len(data) - 7,), np.dtype("<u8"), data, 0, (1,))
    length = np.zeros(len(rows), np.int64)
    live = np.flatnonzero(limit > 0)
    while len(live):
        a = rows[live] + length[live]
        b = before[rows[live]] + length[live]
        differ = eights[a] ^ eights[b]
        low = differ & (~differ + np.uint64(1))  # the lowest bit that differs
        same = np.where(differ == 0, 8, np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64) >> 3)
        length[live] += same
        live = live[(same == 8) & (length[live] < limit[live])]
    prefix = np.zeros(n, np.int64)
    prefix[rows] = np.minimum(length, limit)
    last = np.maximum.accumulate(np.where(measured, place, 0))
    return np.maximum(prefix[last] - (place - last), 0), before


def repeated_starts(data: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """For strings laid end to end in `data` (eight bytes more follow): whether the `width` bytes from each place on, if
    that many are left in its string, also start at another place."""
    if not len(sizes) or not int(sizes.sum()):
        return np.zeros(0, bool)
    many = len(sizes)
    spots = np.arange(int(sizes.sum())) + np.repeat(np.arange(many), sizes)
    text = np.zeros(int(sizes.sum()) + many, np.int64)  # a zero after each string
    raw = np.zeros(len(text) + 8, np.uint8)
    raw[spots] = data[: len(spots)]
    text[spots] = raw[spots].astype(np.int64) + 1
    end = np.repeat(np.cumsum(sizes + 1) - 1, sizes + 1)
    array = suffix_array(text)
    prefix, before = common_prefixes(raw, text, array, end)
    long = prefix >= width
    flags = long.copy()
    flags[before[long]] = True
    return flags[spots]
