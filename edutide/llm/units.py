"""Token ids of whole texts from the ids of their units, each distinct unit encoded once per Python worker.

A unit is a run of non-space bytes, for tokenizers that drop white space, or such a run with the white space before it, for
byte-level tokenizers whose splitting pattern is ` ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`; it is cut once more where
punctuation follows a letter. No match of either pattern spans the end of a unit, so the ids of a text are those of its units
in order. The one exception, Unicode white space beyond ASCII next to ASCII white space, is for the caller to keep away
(`UNUSUAL`). Whether a file's tokenizer is of one of these two kinds is read from the file; any other encodes whole texts.

Units are told apart by a 64-bit hash: among the half million that a worker remembers, two meet with a chance of 1e-8.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa

from .bytewords import LOWER, NOT_SPACE, Words, flat, split

#: White space and separators that units don't treat as such, as a class of characters.
UNUSUAL = "[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Distinct units that a worker remembers; beyond, it forgets those that it has met seldom.
REMEMBERED = 500_000


_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: Second bytes, after 0xC3, of the letters among U+00C0 to U+00FF.
_LATIN = np.zeros(256, bool)
_LATIN[[c for c in range(0x80, 0xC0) if c not in (0x97, 0xB7)]] = True

#: The splitting pattern of the word tokenizer that Units takes apart.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


#: Units of plain letters, which no normalizer but lower-casing changes and no splitting pattern cuts: the merges see them whole.
PLAIN = {"space": re.compile("[ ]?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+"), "word": re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")}
#: The characters by which byte-level tokenizers write bytes: printable ones stand for themselves, the others from 256 on.
_SHOWN = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or c >= 174]
_BYTES = {c: c for c in _SHOWN} | {c: 256 + i for i, c in enumerate(c for c in range(256) if c not in _SHOWN)}


def kind_of(path: str) -> str | None:
    """'space' for byte-level tokenizers, 'word' for those that lower-case and drop white space, null for any other."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    normalizer, pre = found.get("normalizer"), found.get("pre_tokenizer") or {}
    parts = pre.get("pretokenizers", [pre])
    plain = all(not t.get("lstrip") and not t.get("rstrip") and not t.get("single_word") and not t.get("normalized") and t["content"].startswith("<") and t["content"].endswith(">") for t in found.get("added_tokens", []))
    if not plain or found.get("model", {}).get("type") != "BPE" or parts[-1].get("type") != "ByteLevel" or parts[-1].get("add_prefix_space"):
        return None
    if normalizer is None and len(parts) == 1 and parts[0].get("use_regex", True):
        return "space"
    steps = [n.get("type") for n in (normalizer or {}).get("normalizers", [])]
    if steps == ["NFC", "Replace", "Lowercase"] and len(parts) == 2 and parts[0].get("type") == "Split" and parts[0].get("invert") and parts[0]["behavior"] == "Removed" and parts[0]["pattern"].get("Regex") == WORD_PATTERN:
        return "word"
    return None


def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Units:
    def __init__(self, path: str):
        self.tokenizer, self.kind = tokenizer(path), kind_of(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.forget()

    def forget(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ptr, self.size, self.ids = np.zeros(1, np.int64), 0, np.zeros(1 << 16, np.int32)
        self.met = np.zeros(0, np.int32)

    def trim(self) -> None:
        keep = self.met[self.slots] > 3
        if keep.sum() > REMEMBERED // 2:
            self.forget()
            return
        keys, slots = self.keys[keep], self.slots[keep]
        n = self.ptr[slots + 1] - self.ptr[slots]
        upto = np.concatenate([[0], np.cumsum(n)])
        self.ids = self.ids[np.repeat(self.ptr[slots] - upto[:-1], n) + np.arange(upto[-1])]
        self.keys, self.slots, self.ptr, self.size = keys, np.arange(len(keys)), upto, len(self.ids)
        self.met = np.zeros(len(keys), np.int32)

    def spans(self, texts: pa.Array) -> Words:
        w = split(texts, NOT_SPACE, lower=False)
        _, off = flat(texts)
        data, start, end = w.data, w.start, w.end
        # Words with a < may hold special strings, which nothing may cut or change.
        marked = np.concatenate([[0], np.cumsum(data == ord("<"))])
        marked = marked[end] > marked[start]
        before = np.zeros(len(data), bool)
        before[1:] = _LETTER[data[:-1]]
        before[2:] |= (data[:-2] == 0xC3) & _LATIN[data[1:-1]]
        cut = before & _PUNCTUATION[data]
        cut[off[:-1][off[:-1] < len(data)]] = False
        cut = np.flatnonzero(cut)
        if marked.any():
            cut = cut[~marked[np.searchsorted(start, cut, side="right") - 1]]
        if self.kind == "word":
            kept, data = data, LOWER[data]
            for a, b in zip(start[marked].tolist(), end[marked].tolist()):
                data[a:b] = kept[a:b]
        else:
            begin = np.concatenate([[0], end[:-1]]) if len(end) else start.copy()
            full = w.first[:-1] < w.first[1:]
            begin[w.first[:-1][full]] = off[:-1][full]
            last = off[:-1].copy()
            last[full] = end[w.first[1:][full] - 1]
            tail = np.flatnonzero(last < off[1:])
            start, end = np.concatenate([begin, last[tail]]), np.concatenate([end, off[1:][tail]])
        start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
        return Words(data, start, end, np.searchsorted(start, off))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin (one more than texts)."""
        if self.kind is None:
            every = [x.ids for x in self.tokenizer.encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
            return np.fromiter((i for x in every for i in x), np.int32), np.cumsum([0, *map(len, every)])
        if len(self.keys) > REMEMBERED:
            self.trim()
        w = self.spans(texts)
        u, first, inverse, count = np.unique(w.hashes(), return_index=True, return_inverse=True, return_counts=True)
        at = np.searchsorted(self.keys, u)
        known = np.zeros(len(u), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == u[inside]
        if not known.all():
            self._learn(u[~known], [w.text(i).decode() for i in first[~known]])
            at = np.searchsorted(self.keys, u)
        self.met[self.slots[at]] += count.astype(np.int32)
        slot = self.slots[at][inverse] if len(u) else np.zeros(0, np.int64)
        n = self.ptr[slot + 1] - self.ptr[slot]
        upto = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids[np.repeat(self.ptr[slot] - upto[:-1], n) + np.arange(upto[-1])]
        return ids, upto[w.first]

    def _learn(self, keys: np.ndarray, units: list[str]) -> None:
        plain, model = PLAIN[self.kind], self.tokenizer.model
        new: list = [None] * len(units)
        rest = []
        for i, unit in enumerate(units):
            if plain.fullmatch(unit):
                shown = (unit.lower() if self.kind == "word" else unit).encode().decode("latin-1").translate(_BYTES)
                new[i] = [t.id for t in model.tokenize(shown)]
            else:
                rest.append(i)
        for i, x in zip(rest, self.tokenizer.encode_batch_fast([units[i] for i in rest], add_special_tokens=False)):
            new[i] = x.ids
        n = np.fromiter(map(len, new), np.int64, len(new))
        more = int(n.sum())
        if self.size + more > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.size], np.zeros(self.size + 2 * more + (1 << 16), np.int32)])
        self.ids[self.size : self.size + more] = np.fromiter((i for x in new for i in x), np.int32, more)
        slots = np.arange(len(new)) + len(self.ptr) - 1
        self.ptr = np.concatenate([self.ptr, self.size + np.cumsum(n)])
        self.size += more
        self.met = np.concatenate([self.met, np.zeros(len(new), np.int32)])
        keys, slots = np.concatenate([self.keys, keys]), np.concatenate([self.slots, slots])
        order = np.argsort(keys, kind="stable")
        self.keys, self.slots = keys[order], slots[order]


_made: dict[str, Units] = {}


def units(path: str) -> Units:
    """One encoder for each Python worker and file, kept from task to task."""
    if path not in _made:
        _made[path] = Units(path)
    return _made[path]


def dropped(path: str) -> None:
    """Give up this worker's encoder for a file, where what comes next needs its memory more."""
    _made.pop(path, None)
