"""Suffix arrays by induced sorting and permuted common prefixes, vectorised with numpy."""

from __future__ import annotations

import numpy as np


def _kinds(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it; the last one is (it ends first)."""
    n = len(text)
    step = np.sign(text[1:] - text[:-1])  # > 0: the suffix before is smaller
    at = np.where(step != 0, np.arange(n - 1), n - 1)
    at = np.minimum.accumulate(at[::-1])[::-1]  # the next place where neighbours differ
    small = np.ones(n, bool)
    inside = at < n - 1
    small[:-1] = np.where(inside, step[np.minimum(at, max(n - 2, 0))] > 0, False)
    return small


#: Names are sorted by recursion up to so many: buckets are walked one by one.
MOST_BUCKETS = 4096


def _stable_order(chars: np.ndarray, sigma: int) -> np.ndarray:
    """Places of the characters in ascending order; a radix sort while two bytes hold them."""
    return np.argsort(chars.astype(np.uint16) if sigma <= 1 << 16 else chars, kind="stable")


def _place(suffixes: np.ndarray, slots: np.ndarray, order: np.ndarray, chars: np.ndarray,
           sign: int) -> None:
    """Put suffixes, in their order, into the next free slots of their characters' buckets."""
    by = _stable_order(chars, len(slots))
    counts = np.bincount(chars, minlength=len(slots))
    # Where each character's run begins, less than its place: its free slot, counted on.
    shift = slots - sign * (np.cumsum(counts) - counts)
    order[shift[chars[by]] + sign * np.arange(len(by))] = suffixes[by]
    slots += sign * counts


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The suffix array induced from leftmost-smaller suffixes in the given order.

    One pass over the buckets upwards places the larger suffixes, one downwards the smaller
    ones. Within a bucket, those that follow one of the same character come in rounds.
    """
    sigma = len(bounds) - 1
    order = np.full(len(text), -1, np.int64)
    chars = text[lms]
    by_char = _stable_order(chars, sigma)
    seeds, cuts = lms[by_char], np.searchsorted(chars[by_char], np.arange(sigma + 1))
    heads = bounds[:-1].copy()

    def before(suffixes: np.ndarray, kind: bool) -> np.ndarray:
        found = suffixes[suffixes > 0] - 1
        return found[small[found] == kind]

    # The last suffix is no leftmost-smaller one's successor: what precedes the end is placed first.
    for c in range(sigma):
        done = bounds[c]
        while done < heads[c]:
            own = order[done:heads[c]]
            done = heads[c]
            found = before(own, False)
            if len(found):
                _place(found, heads, order, text[found], 1)
        found = before(seeds[cuts[c]:cuts[c + 1]], False)
        if len(found):
            _place(found, heads, order, text[found], 1)
    tails = bounds[1:] - 1
    for c in range(sigma - 1, -1, -1):
        done = bounds[c + 1] - 1
        while done > tails[c]:
            own = order[tails[c] + 1:done + 1][::-1]
            done = tails[c]
            found = before(own, True)
            if len(found):
                _place(found, tails, order, text[found], -1)
        large = order[bounds[c]:heads[c]][::-1]
        found = before(large, True)
        if len(found):
            _place(found, tails, order, text[found], -1)
    return order


def _lms_names(text: np.ndarray, lms: np.ndarray, order: np.ndarray, is_lms: np.ndarray) -> np.ndarray:
    """Ranks of the leftmost-smaller substrings, equal ones sharing a rank."""
    sorted_lms = order[is_lms[order]]
    ends = np.append(lms[1:], len(text) - 1)
    length = np.zeros(len(text), np.int64)
    length[lms] = ends - lms + 1
    a, b = sorted_lms[:-1], sorted_lms[1:]
    same = length[a] == length[b]
    at = np.flatnonzero(same)
    step = 0
    while len(at):
        left, right = a[at] + step, b[at] + step
        differ = text[left] != text[right]
        same[at[differ]] = False
        at = at[~differ]
        step += 1
        at = at[length[a[at]] > step]
    rank = np.zeros(len(text), np.int64)
    rank[sorted_lms] = np.concatenate([[0], np.cumsum(~same)])
    return rank[lms]


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """Suffix array of a string over a large alphabet: ranks of prefixes are doubled.

    A suffix's rank is the first place of those it can't be told from yet; only these are
    sorted again, so a round costs less than the one before.
    """
    n, h = len(names), 1
    order = _stable_order(names, int(names.max()) + 1)
    rank = np.empty(n, np.int64)
    places, keys = np.arange(n), names[order]
    while True:
        new = np.append(True, keys[1:] != keys[:-1])
        rank[order[places]] = places[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        alone = new & np.append(new[1:], True)
        places = places[~alone]
        if not len(places):
            return order
        suffixes = order[places]
        after = np.where(suffixes + h < n, rank[np.minimum(suffixes + h, n - 1)] + 1, 0)
        keys = rank[suffixes] * (n + 1) + after
        by = np.argsort(keys, kind="stable")
        keys, order[places] = keys[by], suffixes[by]
        h *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of a non-negative integer string; a shorter suffix precedes a longer one.

    Suffixes are classified, the leftmost-smaller substrings sorted by induction and named,
    the string of names is sorted (recursively while its alphabet is small enough to walk
    its buckets, else by doubling), and the whole array induced from it in two passes.
    """
    n = len(text)
    if n < 2:
        return np.arange(n)
    # A sentinel below everything else makes the end explicit.
    text = np.append(text.astype(np.int64) + 1, 0)
    small = _kinds(text)
    is_lms = np.zeros(n + 1, bool)
    is_lms[1:] = small[1:] & ~small[:-1]
    lms = np.flatnonzero(is_lms)
    bounds = np.concatenate([[0], np.cumsum(np.bincount(text))])
    order = _induce(text, small, lms, bounds)
    order[0] = n
    names = _lms_names(text, lms, order, is_lms)
    if names.max() + 1 == len(lms):
        deep = np.argsort(names)
    else:
        deep = suffix_array(names) if names.max() < MOST_BUCKETS else _by_doubling(names)
    order = _induce(text, small, lms[deep], bounds)
    order[0] = n
    return order[1:]


def common_prefixes(text: np.ndarray, order: np.ndarray, cap: int) -> np.ndarray:
    """Permuted common prefixes: at each position the length, up to `cap`, that its suffix
    shares with the one before it in the suffix array (0 for the first)."""
    n = len(text)
    found = np.zeros(n, np.int64)
    if n < 2:
        return found
    padded = np.concatenate([text.astype(np.uint8), np.zeros(cap + 8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(
        padded, (n + cap, 8), (1, 1)).copy().view("<u8").reshape(-1)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.flatnonzero(before >= 0)
    step = 0
    while len(at) and step < cap:
        differ = words[at + step] ^ words[before[at] + step]
        low = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8).astype(np.int64)
        found[at] += same
        at = at[same == 8]
        step += 8
    # Nothing is shared beyond the end of the text.
    return np.minimum(found, np.minimum(cap, np.where(
        before < 0, 0, n - np.maximum(np.arange(n), before))))
