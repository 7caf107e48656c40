"""Sequence kernels in numpy: every call compares a whole batch of pairs.

Sequences of a batch lie in one flat array. Pairs of like size are worked
through together, step by step along the shorter sequence: 64 places of the
longer one are one machine word, so a step is a few operations on all pairs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd

#: Cells that are held at once, and words of 64 places beyond which a pair is worked through alone.
CELLS, WIDE = 2_000_000, 32


class Ragged:
    """Sequences of whole numbers: one flat array, where each begins, its size."""

    def __init__(self, flat: np.ndarray, size: np.ndarray) -> None:
        self.flat, self.size = flat, np.asarray(size, np.int64)
        self.begin = np.cumsum(self.size) - self.size

    @classmethod
    def of_texts(cls, texts: list[str]) -> Ragged:
        """Code points."""
        flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.int32)
        return cls(flat, np.fromiter(map(len, texts), np.int64, len(texts)))

    @classmethod
    def of_lists(cls, lists: list) -> Ragged:
        return cls(np.concatenate([np.asarray(x, np.int64) for x in lists] or [np.empty(0, np.int64)]), np.fromiter(map(len, lists), np.int64, len(lists)))

    def __getitem__(self, k: int) -> np.ndarray:
        return self.flat[self.begin[k] : self.begin[k] + self.size[k]]

    def take(self, rows: np.ndarray) -> Ragged:
        size = self.size[rows]
        at = np.repeat(self.begin[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return Ragged(self.flat[at], size)

    def padded(self, rows: np.ndarray, width: int, fill: int) -> np.ndarray:
        out = np.full((len(rows), width), fill, self.flat.dtype)
        size = self.size[rows]
        inside = np.arange(width)[None, :] < size[:, None]
        out[inside] = self.take(rows).flat
        return out


def _chunks(order: np.ndarray, cells: np.ndarray) -> list[np.ndarray]:
    """``order`` cut so that the largest of ``cells`` times the rows stays bounded."""
    out, at = [], 0
    while at < len(order):
        n = max(1, int(CELLS // max(1, cells[order[at]])))
        while n > 1 and cells[order[min(at + n, len(order)) - 1]] * n > 2 * CELLS:
            n //= 2
        out.append(order[at : at + n])
        at += n
    return out


def common_by(equal: Callable[[int], np.ndarray], steps: int, rows: int, width: int) -> np.ndarray:
    """Lengths of the longest common subsequences of ``rows`` pairs.

    ``equal(t)`` tells which of the ``width`` places (a multiple of 64) of the
    one sequence match place t of the other. Bit-parallel: a zero bit marks a
    place at which the length grows.
    """
    words = width // 64
    v = np.full((rows, words), ~np.uint64(0))
    with np.errstate(over="ignore"):
        for t in range(steps):
            m = np.packbits(equal(t), axis=1, bitorder="little").view(np.uint64)
            u = v & m
            if words == 1:
                v = (v + u) | (v & ~m)
                continue
            carry = np.zeros(rows, np.uint64)
            for w in range(words):
                first = v[:, w] + u[:, w]
                total = first + carry
                carry = ((first < u[:, w]) | (total < first)).astype(np.uint64)
                v[:, w] = total | (v[:, w] & ~m[:, w])
    return (width - np.bitwise_count(v).sum(axis=1)).astype(np.int64)


def common_alone(a, b) -> int:
    """The same for one pair of any size, on whole numbers of Python."""
    places: dict = {}
    for i, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        hit = v & places.get(x, 0)
        v = (v + hit | v - hit) & full
    return len(b) - v.bit_count()


def common_lengths(a: Ragged, b: Ragged) -> np.ndarray:
    """Length of the longest common subsequence of every pair."""
    steps, wide = np.minimum(a.size, b.size), np.maximum(a.size, b.size)
    words = -(-wide // 64)
    out = np.zeros(len(a.size), np.int64)
    for k in np.flatnonzero((words > WIDE) & (steps > 0)):
        x, y = a[k].tolist(), b[k].tolist()
        out[k] = common_alone(x, y) if len(x) <= len(y) else common_alone(y, x)
    flip = a.size > b.size
    rows = np.flatnonzero((words <= WIDE) & (steps > 0))
    both = Ragged(np.concatenate([a.flat, b.flat]), np.concatenate([a.size, b.size]))
    short, long = np.where(flip, np.arange(len(flip)) + len(flip), np.arange(len(flip))), np.where(flip, np.arange(len(flip)), np.arange(len(flip)) + len(flip))
    for part in _chunks(rows[np.lexsort((steps[rows], words[rows]))], words * 64):
        width, n = int(words[part].max()) * 64, int(steps[part].max())
        p, t = both.padded(long[part], width, -1), both.padded(short[part], n, -2)
        out[part] = common_by(lambda k, p=p, t=t: p == t[:, k, None], n, len(part), width)
    return out


def edit_distances(a: Ragged, b: Ragged) -> np.ndarray:
    """Levenshtein distance of every pair: a row of the table at a time, for all pairs."""
    out = np.maximum(a.size, b.size)
    rows = np.flatnonzero((a.size > 0) & (b.size > 0))
    for part in _chunks(rows[np.lexsort((a.size[rows], b.size[rows]))], b.size + 1):
        m, n = int(b.size[part].max()), int(a.size[part].max())
        x, y = a.padded(part, n, -2), b.padded(part, m, -1)
        at = np.arange(m + 1)
        row = np.repeat(at[None, :], len(part), axis=0)
        for i in range(n):
            new = np.empty_like(row)
            new[:, 0] = i + 1
            new[:, 1:] = np.minimum(row[:, :-1] + (y != x[:, i, None]), row[:, 1:] + 1)
            new = np.minimum.accumulate(new - at, axis=1) + at
            row = np.where((i < a.size[part])[:, None], new, row)
        out[part] = row[np.arange(len(part)), b.size[part]]
    return out


def common_places(a, b) -> list[int]:
    """The places in ``b`` of one longest common subsequence; going back through
    the rows, up only if that is longer. A row is one whole number."""
    held: dict = {}
    for i, x in enumerate(b):
        held[x] = held.get(x, 0) | 1 << i
    full = (1 << len(b)) - 1
    rows = [full]
    for x in a:
        hit = rows[-1] & held.get(x, 0)
        rows.append((rows[-1] + hit | rows[-1] - hit) & full)
    length = lambda i, j: j - (rows[i] & ((1 << j) - 1)).bit_count()
    out, i, j = [], len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            out.append(j)
        elif length(i - 1, j) > length(i, j - 1):
            i -= 1
        else:
            j -= 1
    return out[::-1]


def nearest_places(texts: list[str], patterns: list[str], most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where in each text its pattern stands with the fewest edits, and how many:
    the leftmost begin, -1 if it takes more than ``most``. A column of the edit
    table at a time, for all pairs; a cell holds its cost and, below it, the
    begin of its best match."""
    a, b = Ragged.of_texts(texts), Ragged.of_texts(patterns)
    place, edits = np.full(len(texts), -1, np.int64), np.zeros(len(texts), np.int64)
    unit = np.int64(1 << 32)
    rows = np.flatnonzero(most > 0)
    for part in _chunks(rows[np.lexsort((a.size[rows], b.size[rows]))], b.size + 1):
        m, n = int(b.size[part].max()), int(a.size[part].max(initial=0))
        t, p = a.padded(part, n, -2), b.padded(part, m, -1)
        down = np.arange(m + 1) * unit
        cell = np.repeat(down[None, :], len(part), axis=0)
        best = np.full(len(part), np.int64(1 << 62))
        last = (np.arange(len(part)), b.size[part])
        for j in range(n):
            new = np.empty_like(cell)
            new[:, 0] = j + 1
            new[:, 1:] = np.minimum(cell[:, :-1] + (p != t[:, j, None]) * unit, cell[:, 1:] + unit)
            cell = np.minimum.accumulate(new - down, axis=1) + down
            best = np.where(j < a.size[part], np.minimum(best, cell[last]), best)
        cost = best // unit
        found = cost <= most[part]
        place[part], edits[part] = np.where(found, best % unit, -1), np.where(found, cost, 0)
    return place, edits


def same_words(pairs: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which pairs of words may be one: one begins with the other, or they begin
    alike and more than nine tenths of the shorter stand in order in the longer."""
    x, y = [words[i] for i in pairs[:, 0]], [words[i] for i in pairs[:, 1]]
    begins = np.fromiter((s.startswith(t) or t.startswith(s) for s, t in zip(x, y)), bool, len(x))
    rest = np.flatnonzero(~begins & np.fromiter((s[:1] == t[:1] for s, t in zip(x, y)), bool, len(x)))
    p, q = Ragged.of_texts([x[i] for i in rest]), Ragged.of_texts([y[i] for i in rest])
    begins[rest] = common_lengths(p, q) > 0.9 * np.minimum(p.size, q.size)
    return begins


def numbered_words(a: list, b: list) -> tuple[Ragged, Ragged]:
    """Lists of words as numbers; words of ``b`` that are a word of ``a`` by its number.

    For each new word of ``a`` the likeliest word of ``b`` (nearest in length,
    the first of equals) gets its number, also if it had one already.
    """
    na, nb = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    codes, words = pd.factorize(np.array([w for x in (*a, *b) for w in x], object))
    if not len(codes):
        return Ragged(codes, na), Ragged(codes, nb)
    row = np.concatenate([np.repeat(np.arange(len(a)), na), np.repeat(np.arange(len(b)), nb)])
    cut = int(na.sum())
    # each different word of a row, known by the place where it stands first
    key = row * len(words) + codes
    _, fa, ia = np.unique(key[:cut], return_index=True, return_inverse=True)
    _, fb, ib = np.unique(key[cut:], return_index=True, return_inverse=True)
    fb = fb + cut
    size = np.fromiter(map(len, words), np.int64, len(words))
    letter = np.fromiter((ord(w[0]) if w else -1 for w in words), np.int64, len(words))
    # pairs within a row that begin with one letter
    group = lambda f: row[f] * 0x110000 + letter[codes[f]]
    order = np.argsort(group(fb), kind="stable")
    low, high = (np.searchsorted(group(fb)[order], group(fa), side) for side in ("left", "right"))
    n = high - low
    x = np.repeat(np.arange(len(fa)), n)
    y = order[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    wx, wy = codes[fa[x]].astype(np.int64), codes[fb[y]].astype(np.int64)
    distinct, which = np.unique(wx * len(words) + wy, return_inverse=True)
    same = same_words(np.stack([distinct // len(words), distinct % len(words)], axis=1), words)[which]
    x, y, wx, wy = x[same], y[same], wx[same], wy[same]
    ratio = np.minimum(size[wx], size[wy]) / np.maximum(size[wx], size[wy])
    order = np.lexsort((fb[y], -ratio, x))
    x, y = x[order], y[order]
    likeliest = np.concatenate([[True], x[1:] != x[:-1]]) if len(x) else np.empty(0, bool)
    x, y = x[likeliest], y[likeliest]
    numbers = fb.copy()
    order = np.argsort(fa[x], kind="stable")  # later words of a overwrite
    numbers[y[order]] = fa[x[order]]
    return Ragged(fa[ia], na), Ragged(numbers[ib], nb)
