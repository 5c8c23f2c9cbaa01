"""Suffix arrays by prefix doubling, for index and repeat operators."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray, depth: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``symbols`` in order, and the rank of each.

    A rank is the first slot of the suffixes that are equal so far; each round doubles the
    compared length and sorts only the suffixes that are not alone yet. With ``depth`` it
    stops once at least so many symbols were compared, and equal ones share a rank.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    value = symbols[order]
    slots, rank = np.arange(n), np.empty(n, dtype=np.int64)
    first = np.ones(n, dtype=bool)
    first[1:] = value[1:] != value[:-1]
    rank[order] = slots[first][np.cumsum(first) - 1]
    still, done = slots, 1
    while depth is None or done < depth:
        group = rank[order[still]]
        shared = np.zeros(len(still), dtype=bool)
        shared[1:] = group[1:] == group[:-1]
        shared[:-1] |= shared[1:]
        still = still[shared]
        if not len(still):
            break
        at = order[still]
        after = at + done
        key = rank[at] * (n + 1)
        inside = after < n
        key[inside] += rank[after[inside]] + 1
        turn = np.argsort(key, kind="stable")
        at, key = at[turn], key[turn]
        order[still] = at
        first = np.ones(len(still), dtype=bool)
        first[1:] = key[1:] != key[:-1]
        rank[at] = still[first][np.cumsum(first) - 1]
        done *= 2
    return order, rank
