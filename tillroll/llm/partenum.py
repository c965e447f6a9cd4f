"""Signatures of the n-gram Jaccard join (PartEnum), in numpy.

Sets are banded by size.  Within a band two sets of Jaccard similarity at
least NUMERATOR / DENOMINATOR differ in at most ``k`` elements, so if the
feature domain is hashed into parts, few parts can differ and the sets agree
on the rest.  A signature is the projection of a set on a subset of parts:

* small ``k``: ``k + 2`` parts, and every pair of them is a signature; two parts
  at least agree, so similar sets share one;
* larger ``k``: ``k + c`` parts, and every single part is one; ``c`` at least agree.

Agreeing on parts that are empty in both says nothing, and such signatures
would be shared by many unrelated sets.  So empty projections are left out,
and a set with so many empty parts that the guarantee is lost also signs under
a new hash of the domain (the next level).  If either set of a similar pair
keeps the guarantee on a level, the pair shares a signature there; if neither
does, both go on to the next level.  On the last one empty projections count.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np

#: Similarity at least 80 / 100.
NUMERATOR, DENOMINATOR = 80, 100
#: Ratio of the largest to the smallest size in a band.
BAND_RATIO = 1.5625
#: With at most this many differing elements, pairs of parts are signatures.
SMALL_K = 3
LEVELS = 6


def least_common(total: int) -> int:
    """Elements two sets of ``total`` elements together must share."""
    return -(-NUMERATOR * total // (NUMERATOR + DENOMINATOR))


def bands(up_to: int) -> list[int]:
    """The smallest size of each band, until one is beyond ``up_to``."""
    low = [1]
    while low[-1] <= up_to:
        low.append(max(low[-1] + 1, math.ceil(low[-1] * BAND_RATIO)))
    return low


_SCHEMES: dict[tuple[int, int], tuple[int, int]] = {}


def scheme(low: int, high: int) -> tuple[int, int]:
    """For pairs whose smaller set has ``low`` to ``high`` elements: the most they
    differ in, and the number of parts."""
    if (low, high) not in _SCHEMES:
        _SCHEMES[low, high] = _scheme(low, high)
    return _SCHEMES[low, high]


def _scheme(low: int, high: int) -> tuple[int, int]:
    largest = high * DENOMINATOR // NUMERATOR
    k = max(t - 2 * least_common(t) for t in range(max(2, low + largest - 20), high + largest + 1))
    if k <= 0:
        return 0, 0
    if k <= SMALL_K:
        return k, k + 2
    parts = k + 1
    while parts < 2 * k:
        empty = parts * math.exp(-low / parts)
        if parts - k > empty + 0.7 * math.sqrt(empty):
            break
        parts += 1
    return k, parts


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser, another one for each seed."""
    x = x + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def digest(sets: list[np.ndarray]) -> np.ndarray:
    """One 64-bit number for each set, from its elements and size; never 0."""
    sums = np.array([mix(s, 7).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
    return (sums + mix(np.array([len(s) for s in sets], dtype=np.uint64), 8)) | np.uint64(1)


def band_jobs(sizes: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(lowest size, highest size, sets) of each band that sets sign in: their own,
    and the one below if a partner may be in it."""
    if not len(sizes):
        return []
    low = np.array(bands(int(sizes.max())))
    own = np.searchsorted(low, sizes, "right") - 1
    smallest = -(-sizes * NUMERATOR // DENOMINATOR)  # of a partner
    jobs = []
    for b in range(len(low) - 1):
        who = np.flatnonzero((own == b) | ((own == b + 1) & (smallest < low[b + 1])))
        if len(who):
            jobs.append((int(low[b]), int(low[b + 1]) - 1, who))
    return jobs


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of some sets (sorted distinct 64-bit features): their numbers
    and the index of the set each belongs to."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    out, owner = [], []
    for low, high, who in band_jobs(sizes):
        k, parts = scheme(low, high)
        if not k:
            continue  # similar sets of these sizes are equal
        for level in range(LEVELS):
            if not len(who):
                break
            flat = np.concatenate([sets[i] for i in who])
            at = np.repeat(np.arange(len(who)), sizes[who])
            part = ((mix(flat, 100 + level) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            place = at * parts + part.astype(np.int64)
            held = np.bincount(place, minlength=len(who) * parts).reshape(len(who), parts)
            sums = np.zeros(len(who) * parts, dtype=np.uint64)
            np.add.at(sums, place, mix(flat, 200))
            sums = sums.reshape(len(who), parts)
            tag = (low << 20) + (level << 16)
            last = level == LEVELS - 1
            if k <= SMALL_K:
                for n, (p, q) in enumerate(combinations(range(parts), 2)):
                    full = np.flatnonzero((held[:, p] + held[:, q] > 0) | last)
                    out.append(mix(sums[full, p] + np.uint64(3) * sums[full, q], tag + n))
                    owner.append(who[full])
                weak = (held == 0).sum(axis=1) >= 2
            else:
                row, p = np.nonzero((held > 0) | last)
                out.append(mix(mix(sums[row, p], tag) + p.astype(np.uint64), 300))
                owner.append(who[row])
                weak = (held == 0).sum(axis=1) >= parts - k
            who = who[weak]
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(owner)
