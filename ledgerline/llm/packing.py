"""Packing token sequences into fixed windows by best-fit decreasing.

Each task packs the documents it reads, some million tokens at a time, so there
is no shuffle and no group to outgrow a task; sequence ids carry the task's
partition number.  Documents longer than a window are first cut into full
windows; the rests, longest first, go to the open window with the least room
that still holds them, found in a segment tree over remaining capacities.
Windows left nearly empty are then cut up to fill the gaps of the others, and
the last open window is written as sequences of power-of-two lengths, which
need no padding.
"""

from __future__ import annotations

import zlib

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import documents

WINDOW = 2048
GROUP_TOKENS = 1 << 22  # tokens packed together
END_ID = 1


class CapacityTree:
    """Open windows by remaining capacity: a segment tree of counts over 0..size."""

    def __init__(self, size: int):
        self.base = 1 << size.bit_length()
        self.count = [0] * (2 * self.base)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, capacity: int, by: int):
        k = self.base + capacity
        while k:
            self.count[k] += by
            k >>= 1

    def put(self, capacity: int, window: int):
        self.open[capacity].append(window)
        self._add(capacity, 1)

    def tightest(self, need: int):
        """Take out (capacity, window) of the least capacity >= need, or None."""
        k = self.base + need
        if not self.count[k]:
            while k > 1 and (k & 1 or not self.count[k + 1]):
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.base:
                k = 2 * k if self.count[2 * k] else 2 * k + 1
        capacity = k - self.base
        self._add(capacity, -1)
        return capacity, self.open[capacity].pop()


def pack(lengths: list[int], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document index, start, length); every position of every
    document lies in exactly one piece, no sequence is longer than ``window``."""
    full, rests = [], []
    for i, n in enumerate(lengths):
        full += [[(i, at, window)] for at in range(0, n - window + 1, window)]
        if n % window:
            rests.append((n % window, i))
    rests.sort(key=lambda r: (-r[0], r[1]))
    tree, windows, room = CapacityTree(window), [], []
    for n, i in rests:
        got = tree.tightest(n)
        if got is None:
            windows.append([])
            room.append(window)
            got = window, len(windows) - 1
        capacity, w = got
        windows[w].append((i, lengths[i] - n, n))
        room[w] = capacity - n
        if room[w]:
            tree.put(room[w], w)
    done = [w for w, r in zip(windows, room) if not r]
    gaps = sorted((w for w in range(len(windows)) if room[w]), key=lambda w: (room[w], w))
    # the emptiest windows are cut up to fill the fullest ones
    loose: list[tuple[int, int, int]] = []
    while gaps:
        target = gaps.pop(0) if len(gaps) > 1 or loose else None
        if target is None:
            break
        while room[target]:
            if not loose:
                if not gaps:
                    break
                loose = windows[gaps.pop()]
            i, at, n = loose.pop()
            k = min(n, room[target])
            windows[target].append((i, at, k))
            room[target] -= k
            if k < n:
                loose.append((i, at + k, n - k))
        if room[target]:
            loose = windows[target] + loose
            break
        done.append(windows[target])
    last = loose + [p for w in gaps for p in windows[w]]
    return full + done + _powers(last, window)


def _powers(pieces, window):
    """Cut loose pieces into full windows and sequences of power-of-two lengths."""
    out, left = [], sum(p[2] for p in pieces)
    queue = list(reversed(pieces))
    while left:
        size = min(window, 1 << (left.bit_length() - 1))
        seq, need = [], size
        while need:
            i, at, n = queue.pop()
            k = min(n, need)
            seq.append((i, at, k))
            need -= k
            if k < n:
                queue.append((i, at + k, n - k))
        out.append(seq)
        left -= size
    return out


SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"
)


def _pack_batches(path, end_id, window, group_tokens, with_ids):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        base, made = TaskContext.get().partitionId() << 40, 0

        def flush(doc_ids, arrays):
            nonlocal made
            rows, ids = [], []
            for seq in pack([a.size for a in arrays], window):
                offset = 0
                for i, at, n in seq:
                    piece = arrays[i][at : at + n]
                    rows.append((doc_ids[i], at, n, zlib.crc32(piece), arrays[i].size, base + made, offset))
                    if with_ids:
                        ids.append(piece.astype(np.int32))
                    offset += n
                made += 1
            cols = [pa.array(c, pa.int64()) for c in zip(*rows)]
            names = SCHEMA.replace(" long", "").replace(" array<int>", "").split(", ")
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(cols, names[: len(cols)])

        doc_ids, arrays, n = [], [], 0
        for doc_id, ids in documents(batches, path, end_id):
            doc_ids.append(doc_id)
            arrays.append(ids.astype("<u4"))
            n += ids.size
            if n >= group_tokens:
                yield flush(doc_ids, arrays)
                doc_ids, arrays, n = [], [], 0
        if doc_ids:
            yield flush(doc_ids, arrays)

    return run


def packed(
    docs: DataFrame,
    tokenizer: str | None = None,
    window: int = WINDOW,
    group_tokens: int = GROUP_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (and with ``with_ids`` the ids themselves).

    NULL and empty texts are the end id alone; a repeated row is packed as often
    as it occurs; a NULL doc_id stays NULL; an empty table gives an empty result;
    other columns are ignored.
    """
    schema = SCHEMA if with_ids else SCHEMA.rsplit(", ", 1)[0]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _pack_batches(tokenizer, END_ID, window, group_tokens, with_ids), schema
    )
