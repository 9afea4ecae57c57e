"""Suffix arrays by induced sorting, over numpy arrays: whole buckets are induced at a time."""

from __future__ import annotations

import numpy as np

from pactloom.llm.common import mix


def classify(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which suffixes are smaller than the next one, and the leftmost of each run of those."""
    differs = t[:-1] != t[1:]
    change = np.flatnonzero(differs)
    smaller = np.ones(len(t), bool)
    if len(change):
        # What holds at the next change holds for the run of equal symbols before it.
        rises = t[change] < t[change + 1]
        smaller[: change[-1] + 1] = np.repeat(rises, np.diff(np.append(-1, change)))
    left = smaller.copy()
    left[0] = False
    left[1:] &= ~smaller[:-1]
    return smaller, np.flatnonzero(left)


def _deal(t: np.ndarray, entries: np.ndarray, bins: dict[int, list[np.ndarray]]) -> None:
    """Appends entries to the bins of their symbols, in their order."""
    symbol = t[entries]
    order = np.argsort(symbol, kind="stable")
    symbol, entries = symbol[order], entries[order]
    cuts = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1]))
    for a, b in zip(cuts, np.append(cuts[1:], len(entries)), strict=True):
        bins.setdefault(int(symbol[a]), []).append(entries[a:b])


def _before(entries: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The suffixes that begin one symbol earlier, those of the wanted class."""
    earlier = entries[entries > 0] - 1
    return earlier[wanted[earlier]]


def induce(t: np.ndarray, smaller: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """All suffixes in order, given the leftmost-smaller ones in order (of their first symbol at least).

    A scan of one bucket appends to later buckets, or to its own end, which is scanned as a further wave. Symbol 0
    separates texts; separators are told apart by where they stand.
    """
    separators = np.flatnonzero(t == 0)
    seeds = np.concatenate([separators, seeds[t[seeds] != 0]])
    larger = ~smaller
    symbols = [int(c) for c in np.unique(t)]
    seeded: dict[int, list[np.ndarray]] = {}
    _deal(t, seeds, seeded)
    bins: dict[int, list[np.ndarray]] = {}
    large: dict[int, list[np.ndarray]] = {}
    for c in symbols:
        done = large[c] = []
        wave = np.concatenate(bins.pop(c)) if c in bins else seeds[:0]
        while len(wave):
            done.append(wave)
            found = _before(wave, larger)
            own = t[found] == c
            _deal(t, found[~own], bins) if not own.all() else None
            wave = found[own]
        if c in seeded:
            found = _before(np.concatenate(seeded[c]), larger)
            _deal(t, found, bins) if len(found) else None
    out: list[np.ndarray] = []
    bins = {}
    for c in reversed(symbols):
        done = []
        if c == 0:
            done.append(separators[::-1])
        else:
            wave = np.concatenate(bins.pop(c)) if c in bins else seeds[:0]
            while len(wave):
                done.append(wave)
                found = _before(wave, smaller)
                own = t[found] == c
                _deal(t, found[~own], bins) if not own.all() else None
                wave = found[own]
        part = np.concatenate(large[c]) if large[c] else seeds[:0]
        found = _before(part[::-1], smaller)
        _deal(t, found, bins) if len(found) else None
        out += [*done, part[::-1]]
    return np.concatenate(out)[::-1]


def _names(t: np.ndarray, ordered: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Names of the leftmost-smaller substrings in their order: equal substrings share one.

    A substring reaches to the next mark inclusive; one with a separator in it is like no other.
    """
    base = np.uint64(0x9E3779B97F4A7C15)
    powers = np.full(len(t) + 1, base)
    powers[0] = 1
    powers = np.cumprod(powers)
    inverse = np.full(len(t) + 1, np.uint64(pow(int(base), -1, 1 << 64)))
    inverse[0] = 1
    inverse = np.cumprod(inverse)
    sums = np.append(np.uint64(0), np.cumsum(mix(t.astype(np.uint64) + np.uint64(1)) * powers[:-1]))
    number = np.empty(len(t), np.int64)
    number[marks] = np.arange(len(marks))
    at = number[ordered]
    end = np.append(marks[1:], len(t) - 1)[at] + 1
    value = (sums[end] - sums[ordered]) * inverse[ordered]
    unique = (t[ordered] == 0) | (t[end - 1] == 0)
    length = end - ordered
    new = np.append(True, (value[1:] != value[:-1]) | (length[1:] != length[:-1]) | unique[1:] | unique[:-1])
    return np.cumsum(new) - 1


def _induce_each(t: np.ndarray, smaller: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The same as ``induce`` for a string of names, whose many symbols have few suffixes each: one suffix at a time.

    Symbols are dense and 0 is the last symbol alone.
    """
    sizes = np.bincount(t)
    ends = np.cumsum(sizes)
    dealt = seeds[np.argsort(t[seeds], kind="stable")]
    symbol = t[dealt]
    from_right = np.searchsorted(symbol, symbol, "right") - np.arange(len(symbol))
    placed = np.full(len(t), -1)
    placed[ends[symbol] - from_right] = dealt
    order = placed.tolist()
    head, tail = (ends - sizes).tolist(), ends.tolist()
    # The symbol before each suffix where that belongs to the pass, else -1; so it is for an empty place (-1) as well.
    before = np.append(t[-1:], t[:-1])
    is_small = np.append(True, smaller[:-1])
    wanted = np.append(np.where(is_small, -1, before), -1).tolist()
    for p in order:
        c = wanted[p]
        if c >= 0:
            i = head[c]
            order[i] = p - 1
            head[c] = i + 1
    is_small[0] = False
    wanted = np.append(np.where(is_small, before, -1), -1).tolist()
    for p in reversed(order):
        c = wanted[p]
        if c >= 0:
            i = tail[c] - 1
            order[i] = p - 1
            tail[c] = i
    return np.array(order)


def _sort_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names, by the suffix array of that string.

    A name that stands once decides each comparison that reaches it, so of those in a row only the first is kept.
    """
    shared = np.bincount(names)[names] > 1
    kept = np.flatnonzero(shared | np.append(False, shared[:-1]))
    _, dense = np.unique(names[kept], return_inverse=True)
    order = suffix_array(np.append(dense + 1, 0), _induce_each)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    among = np.zeros(len(names), np.int64)
    among[kept] = rank[:-1]
    return np.lexsort((among, names))


def suffix_array(t: np.ndarray, induced=induce) -> np.ndarray:
    """The order of all suffixes of ``t``, whose symbol 0 ends each text, the last one too.

    Suffixes are classified, the leftmost-smaller substrings sorted by a first induction and named, the string of the
    names sorted the same way where names repeat, and the whole order induced from that of the names.
    """
    smaller, marks = classify(t)
    rough = induced(t, smaller, marks)
    is_mark = np.zeros(len(t), bool)
    is_mark[marks] = True
    ordered = rough[is_mark[rough]]
    names = _names(t, ordered, marks)
    if len(names) and names[-1] + 1 < len(names):
        text_order = np.empty(len(t), np.int64)
        text_order[ordered] = names
        ordered = marks[_sort_names(text_order[marks])]
    return induced(t, smaller, ordered)


def permuted_common_prefixes(t: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix, in text order (symbols below 2^16): its predecessor in ``order`` (-1 for the first) and their common prefix.

    Where the symbols before both differ the prefix is compared, four symbols at a time; elsewhere it is one less
    than that of the suffix before.
    """
    before = np.full(len(t), -1)
    before[order[1:]] = order[:-1]
    words = np.zeros(len(t), np.uint64)
    for j in range(4):
        words <<= np.uint64(16)
        words[: max(0, len(t) - j)] |= t[j:].astype(np.uint64)
    at = np.arange(len(t))
    start = (before < 0) | (at == 0) | (before == 0)
    start |= t[at - 1] != t[before - 1]
    # A separator equals nothing, so what begins after one is compared as well.
    start |= t[at - 1] == 0
    heads = np.flatnonzero(start & (before >= 0))
    length = np.zeros(len(t), np.int64)
    ends = np.flatnonzero(t == 0)
    room = np.repeat(ends, np.diff(np.append(-1, ends))) - at
    room = np.minimum(room, room[before])
    live, depth = heads, 0
    while len(live):
        differ = words[live + depth] ^ words[before[live] + depth]
        length[live] = depth + sum(differ < np.uint64(1 << b) for b in (16, 32, 48)) + (differ == 0)
        depth += 4
        live = live[(differ == 0) & (room[live] > depth)]
    length = np.minimum(length, room)
    known = np.where(start, length + at, 0)
    last = np.maximum.accumulate(np.where(start, at, 0))
    return before, np.where(before >= 0, np.maximum(known[last] - at, 0), 0)


def repeated(t: np.ndarray, width: int) -> np.ndarray:
    """Starts of the ``width`` symbols in a row, none a separator, that also start elsewhere in ``t``."""
    order = suffix_array(t)
    before, common = permuted_common_prefixes(t, order)
    hit = np.flatnonzero(common >= width)
    return np.unique(np.concatenate([hit, before[hit]]))
