"""Hashed character n-gram counts of whole texts (task side, numpy)."""

from __future__ import annotations

from .common import worker_cache

DIMS = 2048


def _alphabet():
    """Per code point: is it a letter, and its one-character lower case."""
    import sys

    import numpy as np

    cache = worker_cache("alphabet")
    if not cache:
        n = sys.maxunicode + 1
        letter = np.fromiter((chr(i).isalpha() for i in range(n)), bool, n)
        lower = np.arange(n, dtype=np.uint32)
        letters = np.flatnonzero(letter)
        lower[letters] = np.fromiter((ord(chr(i).lower()[0]) for i in letters.tolist()), np.uint32, letters.size)
        cache["letter"], cache["lower"] = letter, lower
    return cache["letter"], cache["lower"]


def code_points(text: str):
    import numpy as np

    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def letters_only(cps):
    """Lower-case letters; every run of other characters becomes one space, and
    the text starts and ends with one."""
    import numpy as np

    letter, lower = _alphabet()
    keep = letter[cps]
    c = np.where(keep, lower[cps], np.uint32(32))
    c = np.concatenate(([np.uint32(32)], c, [np.uint32(32)]))
    again = np.concatenate(([False], (c[1:] == 32) & (c[:-1] == 32)))
    return c[~again] if keep.any() else c[:0]


def ngram_counts(c, dims: int = DIMS, chunk: int = 1 << 20):
    """Counts of the 1-, 2- and 3-grams of ``c``, hashed into ``dims`` cells."""
    import numpy as np

    out = np.zeros(dims)
    for at in range(0, c.size, chunk):
        part = c[at : at + chunk + 2].astype(np.uint64)
        head = part[: min(chunk, part.size)]
        for n in (1, 2, 3):
            k = min(head.size, part.size - n + 1)
            if k <= 0:
                continue
            h = part[:k] + np.uint64(n << 40)
            for j in range(1, n):
                h = h * np.uint64(0x100000001B3) + part[j : j + k]
            h *= np.uint64(0x9E3779B97F4A7C15)
            out += np.bincount((h >> np.uint64(40)).astype(np.int64) % dims, minlength=dims)
    return out


def unit(v):
    import numpy as np

    n = float(np.sqrt(v @ v))
    return v / n if n else v
