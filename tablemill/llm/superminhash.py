"""SuperMinHash signatures (Ertl, 2017) of many sets at once.

Every element walks through its own random permutation of the ``m`` slots: its j-th slot gets the
value j + r with r uniform in [0, 1), and a slot keeps its minimum.  An element's values only
rise, so a set is finished as soon as its largest slot is below the next step ("early stopping");
the minimum does not depend on the order of elements, so all elements of all sets take step j
together here.
"""

from __future__ import annotations

import numpy as np

from tablemill.llm.textbuf import mix64

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)
#: Sets with fewer elements take many steps and so keep whole permutations; others replay their few swaps.
_DENSE = 300


def _steps(values: np.ndarray, owner: np.ndarray, sets: int, m: int, dense: bool) -> np.ndarray:
    sig = np.full(sets * m, _EMPTY, dtype=np.uint64)
    swaps: list[np.ndarray] = []
    perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(values), 1)) if dense else None
    for j in range(m):
        if not len(values):
            break
        drawn = mix64(values + _U((j + 1) * int(_GOLD) & 0xFFFFFFFFFFFFFFFF))
        k = (j + (drawn & _U(0xFFFFFFFF)) % _U(m - j)).astype(np.int64)
        if dense:
            rows = np.arange(len(values))
            slot = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[:, j]
        else:
            slot = k.copy()
            for t in range(len(swaps) - 1, -1, -1):
                slot[slot == swaps[t]] = t
            swaps.append(k)
        np.minimum.at(sig, owner * m + slot, (_U(j) << _U(32)) | (drawn >> _U(32)))
        open_sets = sig.reshape(sets, m).max(axis=1) >= (_U(j + 1) << _U(32))
        keep = open_sets[owner]
        if not keep.all():
            values, owner = values[keep], owner[keep]
            if dense:
                perm = perm[keep]
            else:
                swaps = [x[keep] for x in swaps]
    return sig.reshape(sets, m)


def signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    """len(sets) x m slots of 16 bits; an empty set's slots are all alike and must not be banded."""
    out = np.full((len(sets), m), _EMPTY, dtype=np.uint64)
    size = np.array([len(x) for x in sets], dtype=np.int64)
    for dense, which in ((True, np.flatnonzero((size > 0) & (size < _DENSE))), (False, np.flatnonzero(size >= _DENSE))):
        if len(which):
            values = np.concatenate([sets[i] for i in which])
            owner = np.repeat(np.arange(len(which)), size[which])
            out[which] = _steps(values, owner, len(which), m, dense)
    return (mix64(out) >> _U(48)).astype(np.uint16)


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """len(sig) x bands keys of 64 bits, each from ``rows`` consecutive slots and the band's number."""
    n, m = sig.shape
    bands = m // rows
    parts = sig[:, : bands * rows].reshape(n, bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _GOLD, (n, bands)).copy()
    for r in range(rows):
        key = mix64(key * _U(31) + parts[:, :, r] + _U(1))
    return key
