"""Token ids of whole texts, by a public tokenizer (task side).

A byte-level BPE merges inside the pieces its splitting pattern yields, so the
ids of a text are those of its pieces in turn.  Texts of plain characters are cut
with numpy (``pieces.py``), a million characters together.  The distinct pieces of
some million characters are looked up together, by Arrow, among those whose ids the
worker keeps; only the others are looked at one by one, by the tokenizer.  Texts with characters outside the
plain range below go to the tokenizer whole, and so do all texts if the tokenizer
does not split by that pattern.
"""

from __future__ import annotations

import re
from itertools import chain

from . import pieces as pre
from .common import worker_cache

TOKENIZER = "byte_bpe_50k.json"
KNOWN_PIECES = 1 << 18  # pieces a worker keeps
LONG_PIECE = 64  # bytes of a piece that is not kept
CHUNK_CHARS = 1 << 20  # characters cut at a time
GROUP_CHARS = 1 << 23  # characters whose distinct pieces are looked up together

# Plain characters: every version of Unicode agrees on their classes.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_PLAIN = re.compile(rf"[\t\n\r\x20-\x7e{_LETTERS}]*")
_BREAK = re.compile("[A-Za-z](?= [A-Za-z])")  # the pattern always splits after this letter

# How a tokenizer file says that it splits by the pattern of ``pieces.py``.
_SPLITS = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def _classes():
    """Classes of the plain characters."""
    import numpy as np

    cache = worker_cache("plain classes")
    if not cache:
        out = np.full(0x250, pre.OTHER, np.uint8)
        for i in range(out.size):
            if re.match(f"[{_LETTERS}]", chr(i)):
                out[i] = pre.LETTER
        out[ord("0") : ord("9") + 1] = pre.NUMBER
        out[[9, 10, 13, 32]] = pre.SPACE
        cache["table"] = out
    return cache["table"]


def parts(text: str, size: int = CHUNK_CHARS):
    """Cut a very long text where the pattern splits it anyway."""
    at = 0
    while len(text) - at > 2 * size:
        m = _BREAK.search(text, at + size)
        if not m:
            break
        yield text[at : m.end()]
        at = m.end()
    yield text[at:]


def _runs(texts, chars: int):
    """Slices of consecutive texts of at most ``chars`` characters, or of one text."""
    at = 0
    while at < len(texts):
        end, n = at + 1, len(texts[at])
        while end < len(texts) and n + len(texts[end]) <= chars:
            n += len(texts[end])
            end += 1
        yield slice(at, end)
        at = end


def _byte_letters():
    """The letter a byte-level model knows each byte by: visible Latin-1 characters
    stand for themselves, the other bytes for the code points from 256 on, in order."""
    import numpy as np

    cache = worker_cache("byte letters")
    if not cache:
        # fixed values: the visible ones
        own = {*range(33, 127), *range(161, 173), *range(174, 256)}
        out = np.arange(256, dtype="<u2")
        others = [b for b in range(256) if b not in own]
        out[others] = 256 + np.arange(len(others))
        cache["table"] = out
    return cache["table"]


class Encoder:
    """``encode(texts)``: one array of ids per text, by the tokenizers library."""

    def __init__(self, path: str | None = None, known: int = KNOWN_PIECES):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import numpy as np
        import pyarrow as pa
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [s.content for s in self.tokenizer.get_added_tokens_decoder().values()]
        settings = json.loads(self.tokenizer.to_str())
        how = settings.get("pre_tokenizer") or {}
        self.splits = settings["model"]["type"] == "BPE" and settings.get("normalizer") is None and _SPLITS == {k: how.get(k) for k in _SPLITS}
        # pieces kept; the NUL between two texts is one of no ids
        self.known, self.index = known, pa.array([b"\0"], pa.binary())
        self.ids, self.starts = np.empty(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)
        self.used = 0  # ids in use; starts[: len(index) + 1] is in use

    def _whole(self, texts):
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces):
        """Ids of the pieces (an Arrow array), numbered after those kept."""
        import numpy as np

        merge = self.tokenizer.model.tokenize
        data, ends = pre.buffer_of(pieces)
        spelt, ends = _byte_letters()[data].tobytes().decode("utf-16-le"), ends.tolist()
        new = [[t.id for t in merge(spelt[a:b])] for a, b in zip(ends, ends[1:])]
        lengths = np.fromiter(map(len, new), np.int64, len(new))
        n, m = len(self.index), self.used + int(lengths.sum())
        if m > self.ids.size:
            self.ids = np.concatenate([self.ids, np.empty(2 * m - self.ids.size, np.uint32)])
        if n + len(new) + 1 > self.starts.size:
            self.starts = np.concatenate([self.starts, np.zeros(n + 2 * len(new), np.int64)])
        self.ids[self.used : m] = np.fromiter(chain.from_iterable(new), np.uint32, m - self.used)
        self.starts[n + 1 : n + 1 + len(new)] = self.used + np.cumsum(lengths)

    def _plain(self, texts):
        """Ids of plain texts."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        found, counts = [], [np.zeros(1, np.int64)]
        for group in _runs(texts, CHUNK_CHARS):
            cut, _, n = pre.cut(texts[group], _classes())
            n[:-1] += 1  # the NUL after a text
            found.append(cut)
            counts.append(n)
        coded = pa.concat_arrays(found).dictionary_encode()
        words = coded.dictionary
        number = pc.index_in(words, value_set=self.index).fill_null(-1).to_numpy().copy()
        missing = np.flatnonzero(number < 0)
        kept = 0
        if missing.size:
            long = pc.binary_length(words).to_numpy()[missing] > LONG_PIECE
            missing = missing[np.argsort(long, kind="stable")]
            new = words.take(pa.array(missing))
            self._learn(new)
            number[missing] = len(self.index) + np.arange(missing.size)
            kept = max(0, min(self.known - len(self.index), missing.size - int(long.sum())))
        k = coded.indices.to_numpy()
        start, size = self.starts[number], self.starts[number + 1] - self.starts[number]
        size = size[k]
        ends = np.cumsum(size)
        flat = np.repeat(start[k] - ends + size, size)
        flat += np.arange(flat.size)
        flat = self.ids.take(flat)
        bounds = np.concatenate([[0], ends])[np.cumsum(np.concatenate(counts))].tolist()
        if kept:
            self.index = pa.concat_arrays([self.index, new[:kept]])
            self.used = int(self.starts[len(self.index)])
        return [flat[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: list[str]):
        import numpy as np

        pieces, owner = [], []
        for i, t in enumerate(texts):
            for p in parts(t):
                pieces.append(p)
                owner.append(i)
        out: list = [[] for _ in texts]
        for run in _runs(pieces, GROUP_CHARS):
            group = range(run.start, run.stop)
            plain = [i for i in group if self.splits and _PLAIN.fullmatch(pieces[i]) and not any(s in pieces[i] for s in self.special)]
            other = sorted(set(group) - set(plain))
            got = dict(zip(plain, self._plain([pieces[i] for i in plain]) if plain else []))
            if other:
                whole = self._whole([pieces[i] for i in other])
                got |= {i: np.array(x, np.uint32) for i, x in zip(other, whole)}
            for i in group:
                out[owner[i]].append(got[i])
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]


def encoder(path: str | None = None) -> Encoder:
    """This worker's encoder."""
    cache = worker_cache("encoders")
    if path not in cache:
        cache[path] = Encoder(path)
    return cache[path]


def documents(batches, path: str | None, end_id: int):
    """Arrow batches (doc_id, text) -> (doc_id, ids with the end id) per row."""
    import numpy as np

    enc = encoder(path)
    tail = np.array([end_id], np.uint32)
    for b in batches:
        ids, texts = b.column(0), b.column(1)
        at = 0
        while at < b.num_rows:  # as many rows as make up one group of characters
            end, chars, group = at, 0, []
            while end < b.num_rows and chars < GROUP_CHARS:
                group.append(texts[end].as_py() or "")
                chars += len(group[-1])
                end += 1
            for doc_id, x in zip(ids[at:end].to_pylist(), enc.encode(group)):
                yield doc_id, np.concatenate([x, tail])
            at = end
