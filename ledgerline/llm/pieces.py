"""Cutting texts into pre-tokens with numpy (task side).

The splitting pattern of byte-level BPE vocabularies is decided by the classes
of neighbouring characters alone, so its matches are found for a whole run of
texts at once: a piece starts where the class changes, but for one blank before
a word, the last of several white-space characters, and contractions.
"""

from __future__ import annotations

from .common import worker_cache

# Fixed value: the splitting pattern that ``starts`` carries out.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

OTHER, LETTER, NUMBER, SPACE, EDGE = range(5)
WINDOW_CHARS = 1 << 20  # characters cut at a time


def unicode_classes():
    """Class of every code point by the Unicode tables of the tiktoken library
    (other libraries know other versions of Unicode)."""
    import numpy as np
    import tiktoken

    cache = worker_cache("pieces")
    if "classes" not in cache:
        out = np.zeros(0x110000, np.uint8)
        every = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
        single = {bytes([i]): i for i in range(256)}
        for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
            e = tiktoken.Encoding(f"class {kind}", pat_str=pattern, mergeable_ranks=single, special_tokens={})
            found = bytes(e.encode_ordinary(every)).decode()
            out[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
        cache["classes"] = out
    return cache["classes"]


def starts(c, k):
    """Where pieces start: ``c`` code points, ``k`` their classes.  Characters of
    class EDGE stand between texts and are pieces of their own."""
    import numpy as np

    n = c.size
    s = np.ones(n, bool)
    if n < 2:
        return np.flatnonzero(s)
    np.not_equal(k[1:], k[:-1], out=s[1:])
    s |= k == EDGE
    # the last character of a white-space run before something visible: a blank
    # belongs to what follows, any other is a piece of its own
    last = np.flatnonzero((k[:-1] == SPACE) & s[1:] & (k[1:] < SPACE))
    s[last] = True
    s[last[c[last] == 32] + 1] = False
    # contractions start at an apostrophe that starts a piece of one character
    a = np.flatnonzero((c[:-1] == 39) & s[:-1] & (k[1:] == LETTER) & s[1:])
    one, two = c[a + 1], c[np.minimum(a + 2, n - 1)] * (a + 2 < n)
    short = np.isin(one, [ord(x) for x in "stmd"])
    long = np.zeros(a.size, bool)
    for x, y in ("re", "ve", "ll"):
        long |= (one == ord(x)) & (two == ord(y))
    for at, size in ((a[short], 2), (a[long], 3)):
        s[at + 1] = False
        end = at + size
        s[end[end < n]] = True
    return np.flatnonzero(s)


def _encoded(text: str, classes):
    """UTF-8 bytes, code points, their classes, and the byte at which each starts (None: as many)."""
    import numpy as np

    data = text.encode("utf-8", "surrogatepass")
    if len(data) == len(text):
        c = np.frombuffer(data, np.uint8)
        return data, c, classes[:256][c], None
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    size = 1 + (c >= 0x80).astype(np.int32) + (c >= 0x800) + (c >= 0x10000)
    at = np.zeros(c.size + 1, np.int32)
    np.cumsum(size, out=at[1:])
    return data, c, classes[c], at


def _array(data, first, end):
    """Arrow array of the byte strings that start at ``first`` and fill ``data`` up to ``end``."""
    import numpy as np
    import pyarrow as pa

    offsets = np.append(first, end).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), first.size, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def buffer_of(array):
    """Bytes of an Arrow binary array without NULLs as a numpy array, and where its values end, from 0."""
    import numpy as np

    _, offsets, data = array.buffers()
    ends = np.frombuffer(offsets, np.int32)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def cut(texts: list[str], classes):
    """(Arrow array of the pieces of all texts, number of pieces of each text).

    For texts of some million characters together; see ``cut_long``."""
    import numpy as np

    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    edges = np.cumsum(sizes + 1)[:-1] - 1  # a NUL between two texts
    data, c, k, at = _encoded("\0".join(texts), classes)
    k[edges] = EDGE
    s = starts(c, k)
    inner = k[s] != EDGE
    counts = np.bincount(np.searchsorted(edges, s[inner]), minlength=len(texts)) if len(texts) else np.zeros(0, np.int64)
    first, end = (s, len(data)) if at is None else (at[s], at[-1])
    return _array(data, first, end), inner, counts


def cut_long(text: str, classes, window: int = WINDOW_CHARS):
    """Arrow arrays of the pieces of one text of any length, a window at a time.

    Matching has no memory, so it can go on at any piece already found; the last
    pieces of a window are found again with what follows them in sight."""
    at, size = 0, window
    while at < len(text):
        part = text[at : at + size]
        data, c, k, where = _encoded(part, classes)
        s = starts(c, k)
        if at + size >= len(text):
            yield _array(data, s if where is None else where[s], len(data))
            return
        if s.size < 8:  # one piece fills the window
            size *= 2
            continue
        stop = int(s[-4])
        s = s[:-4]
        yield _array(data, s if where is None else where[s], stop if where is None else where[stop])
        at, size = at + stop, window
