"""Token ids of many texts: each distinct piece of text is encoded once per worker.

Texts are cut only where the tokenizers here always begin a new piece: at the start of a run
of white space, after a single line break, and before a closing mark that follows a letter.
The ids of the whole text are then the ids of its pieces, one after the other.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from tidemark.llm.textbatch import WHITE, ragged, range_hashes, text_bytes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b".,;:!?")] = True
#: Separators 0x1C-0x1F, which some libraries count as white space.
_ODD = np.zeros(256, dtype=bool)
_ODD[0x1C:0x20] = True
#: First bytes of characters that may be white space beyond ASCII.
_LEAD = np.zeros(256, dtype=bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_PLAIN = re.compile(r" ?[A-Za-z]+")


def pieces(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Start of every piece of the texts data[at[i]:at[i + 1]]."""
    n = len(data)
    white = WHITE[data]
    last = np.zeros((3, n), dtype=np.uint8)
    for k in (1, 2, 3):
        last[k - 1, k:] = data[: n - k]
    unsure = _ODD[last[0]] | (last[0] >= 0x80) & (
        ((last[1] == 0xC2) & ((last[0] == 0x85) | (last[0] == 0xA0)))
        | ((last[2] >= 0xE1) & (last[2] <= 0xE3))
    )
    run = white & ~WHITE[last[0]] & ~unsure
    cut = np.zeros(n + 1, dtype=bool)
    cut[:n] = run
    following = ~(white | _ODD[data] | _LEAD[data])
    cut[1:n] |= run[:-1] & (data[:-1] != 32) & following[1:]
    close = np.ones(n, dtype=bool)
    close[:-1] = white[1:]
    close[at[at > 0] - 1] = True
    cut[:n] |= _MARK[data] & _LETTER[last[0]] & close
    cut[at] = True
    return np.flatnonzero(cut[:n])


class Encoder:
    """Ids by one `tokenizers` file; no special tokens are added.

    With `special`, one that stands in a text has its own id, as by the unchanged file; else
    it is spelled out. Remembers at most `remembered` pieces; beyond that it forgets all and goes on.
    """

    def __init__(self, path: str, remembered: int = 1 << 19, special: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.remembered = remembered
        self._forget()
        # How this tokenizer presents ASCII letters, with and without a space before, to its model.
        self._space, self._lower = self._form(" Qa")[:-2], self._form("Qa").islower()

    def _form(self, piece: str) -> str:
        t = self.tokenizer
        text = t.normalizer.normalize_str(piece) if t.normalizer else piece
        return "".join(x for x, _ in t.pre_tokenizer.pre_tokenize_str(text))

    def _forget(self) -> None:
        # Hashes of the pieces in ascending order, and where each one's ids are in the store.
        self._known = np.zeros(0, np.uint64)
        self._starts = self._sizes = np.zeros(0, np.int32)
        self._store, self._used = np.zeros(1 << 16, np.uint32), 0

    def _encode(self, texts: list[str]) -> list[list[int]]:
        out: list[list[int] | None] = []
        hard = []
        tokenize = self.tokenizer.model.tokenize
        for text in texts:
            if _PLAIN.fullmatch(text):
                word = self._space + text[1:] if text[0] == " " else text
                out.append([x.id for x in tokenize(word.lower() if self._lower else word)])
            else:
                hard.append(text)
                out.append(None)
        found = iter(self.tokenizer.encode_batch_fast(hard, add_special_tokens=False))
        return [next(found).ids if x is None else x for x in out]

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash among the known ones, and whether it is there."""
        at = np.searchsorted(self._known, hashes)
        there = np.zeros(len(hashes), dtype=bool)
        inside = at < len(self._known)
        there[inside] = self._known[at[inside]] == hashes[inside]
        return at, there

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        found = self._encode(texts)
        sizes = np.array([len(ids) for ids in found], dtype=np.int32)
        ids = np.fromiter((i for part in found for i in part), np.uint32, int(sizes.sum()))
        end = self._used + len(ids)
        if end > len(self._store):
            self._store = np.concatenate((self._store, np.zeros(end, np.uint32)))
        self._store[self._used : end] = ids
        starts = (self._used + np.cumsum(sizes) - sizes).astype(np.int32)
        self._used = end
        known = np.concatenate((self._known, hashes))
        order = np.argsort(known, kind="stable")
        self._known = known[order]
        self._starts = np.concatenate((self._starts, starts))[order]
        self._sizes = np.concatenate((self._sizes, sizes))[order]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each."""
        data, at = text_bytes(column)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(at) - 1, np.int64)
        starts = pieces(data, at)
        ends = np.append(starts[1:], len(data))
        coded = pa.array(range_hashes(data, starts, ends)).dictionary_encode()
        code = coded.indices.to_numpy()
        distinct = coded.dictionary.to_numpy()
        if len(self._known) + len(distinct) > self.remembered:
            self._forget()
        _, there = self._places(distinct)
        new = np.flatnonzero(~there)
        if len(new):
            where = np.zeros(len(distinct), dtype=np.int64)
            where[code[::-1]] = np.arange(len(code))[::-1]
            raw = data.tobytes()
            texts = [
                raw[starts[k] : ends[k]].decode("utf-8", "replace") for k in where[new].tolist()
            ]
            self._learn(distinct[new], texts)
        at_known, _ = self._places(distinct)
        slots = at_known[code]
        lengths = self._sizes[slots].astype(np.int64)
        ids = self._store[ragged(self._starts[slots].astype(np.int64), lengths)]
        total = np.concatenate(([0], np.cumsum(lengths)))[np.searchsorted(starts, at)]
        return ids, np.diff(total)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each file in a worker; its pieces serve all tasks that it runs."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, special=True)
    return _ENCODERS[path]
