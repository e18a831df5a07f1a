"""Suffix order and longest-previous-factor arrays in numpy, compared to a fixed depth."""

from __future__ import annotations

import numpy as np


def depths(depth: int) -> list[int]:
    """Lengths that doubling compares: 8, 16, ... and at last ``depth`` itself (8 or more)."""
    found = [8]
    while found[-1] * 2 < depth:
        found.append(found[-1] * 2)
    return found + [depth] * (depth > 8)


def numbered(keys: np.ndarray) -> np.ndarray:
    """Rank of each key among the distinct keys."""
    order = np.argsort(keys)
    held = keys[order]
    ranks = np.empty(len(keys), np.uint32)
    ranks[order] = np.cumsum(np.r_[False, held[1:] != held[:-1]], dtype=np.uint32)
    return ranks


def prefix_ranks(data: np.ndarray, depth: int) -> list[np.ndarray]:
    """For each of ``depths``, every suffix's rank by that many first bytes; zeros follow the end."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    keys = np.zeros(n, np.uint64)
    for k in range(8):
        keys = keys << np.uint64(8) | padded[k : k + n]
    ranks = [numbered(keys)]
    sizes = depths(depth)
    for have, want in zip(sizes, sizes[1:], strict=False):
        shift = want - have
        later = np.zeros(n, np.uint64)
        later[: max(0, n - shift)] = ranks[-1][shift:] + np.uint64(1)
        ranks.append(numbered(ranks[-1].astype(np.uint64) << np.uint64(32) | later))
    return ranks


def common_prefix(ranks: list[np.ndarray], depth: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common prefix of suffixes a and b, up to ``depth``, in whole bytes of 8."""
    n = len(ranks[0])
    full = ranks[-1][a] == ranks[-1][b]
    shared = np.zeros(len(a), np.int64)
    for size, rank in zip(depths(depth)[-2::-1], ranks[-2::-1], strict=True):
        x, y = a + shared, b + shared
        able = (x < n) & (y < n)
        same = np.zeros(len(a), bool)
        same[able] = rank[x[able]] == rank[y[able]]
        shared[same] += size
    return np.where(full, depth, np.minimum(shared, depth - 1))


def nearest_smaller(places: np.ndarray) -> np.ndarray:
    """For each entry the nearest one before it with a smaller value, or -1.

    All entries look at once: one that meets a larger value goes on to where that one looks.
    """
    looks = np.arange(-1, len(places) - 1)
    open_ = np.flatnonzero(looks >= 0)
    while len(open_):
        open_ = open_[places[looks[open_]] > places[open_]]
        looks[open_] = looks[looks[open_]]
        open_ = open_[looks[open_] >= 0]
    return looks


def longest_previous(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous factor of the suffixes at ``starts`` (rising), and the start it was met at.

    The previous and the next smaller position in suffix order hold the best earlier matches;
    lengths count up to ``depth``, lower ones in steps of 8 bytes. A source is -1 if nothing matches.
    """
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ranks = prefix_ranks(data, depth)
    order = starts[np.argsort(ranks[-1][starts], kind="stable")]
    best, source = np.zeros(len(order), np.int64), np.full(len(order), -1)
    before = nearest_smaller(order)
    after = len(order) - 1 - nearest_smaller(order[::-1])[::-1]
    for looks, able in ((before, before >= 0), (after, after < len(order))):
        at = np.flatnonzero(able)
        other = order[looks[at]]
        length = common_prefix(ranks, depth, order[at], other)
        better = length > best[at]
        best[at[better]], source[at[better]] = length[better], other[better]
    by_place = np.argsort(order)
    return best[by_place], source[by_place]
