"""Token ids of whole texts by a public tokenizer, with each distinct piece of text tokenised once per worker.

A text is cut where the tokenizer cannot see across: before white space that follows another character (byte-level
vocabularies keep the space with the next word), or at white space (vocabularies that drop it).  The ids of a piece do
not depend on its neighbours, so the library is called for pieces that the worker has not met, and the ids
of a text are put together from the table.  The table is emptied at ``MOST_PIECES`` (``most`` of a class).
"""

from __future__ import annotations

import json
import os
import sys
import types

import numpy as np

from larkspur.llm import arrays as A

MOST_PIECES = 3_000_000
GROUP = 64  # pieces given to the library in one text
MARK = "\x01"  # stands between pieces where white space is dropped
#: Bytes that may end a character that is white space in Unicode, beyond ASCII.
DOUBTFUL = np.zeros(256, bool)
DOUBTFUL[[*range(0x00, 0x21), 0x7F, *range(0x80, 0x8B), 0x85, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True


def worker_store() -> dict:
    """A dictionary that lives as long as the Python worker."""
    return vars(sys.modules.setdefault("larkspur_worker_store", types.ModuleType("larkspur_worker_store"))).setdefault("encoders", {})


def encoder(path: str) -> Encoder:
    store = worker_store()
    if path not in store:
        store[path] = Encoder(path)
    return store[path]


class Encoder:
    most = MOST_PIECES

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.drops_space = bool(model.get("end_of_word_suffix"))
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.texts = [""] * (max(vocabulary.values()) + 1)
        for text, k in vocabulary.items():
            self.texts[k] = text
        self.bytes = np.array([len(t) for t in self.texts])  # byte-level: a character stands for a byte
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, A.U)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def sentence_ends(self) -> np.ndarray:
        """Which ids end a sentence."""
        suffix = "</w>" if self.drops_space else ""
        return np.array([bool(t) and t.endswith(suffix) and t.removesuffix(suffix)[-1:] in (".", "!", "?") for t in self.texts])

    def _pieces(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        if self.drops_space:
            w = A.words(raw, offsets)
            return w.start, w.stop, w.hash, w.first
        space = A.SPACE[raw]
        begins = np.zeros(len(raw), bool)
        begins[1:] = space[1:] & ~space[:-1] & ~DOUBTFUL[raw[:-1]]
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        start = np.flatnonzero(begins)
        stop = np.r_[start[1:], len(raw)] if len(start) else start
        return start, stop, A.Spans(A.WEIGHT[raw]).hash(start, stop), np.searchsorted(start, offsets)

    def _learn(self, keys: np.ndarray, texts: list[bytes]) -> None:
        found: list[np.ndarray | None] = [None] * len(texts)
        alone, joined = [], []
        for k, t in enumerate(texts):
            if self.drops_space:
                (alone if MARK.encode() in t else joined).append(k)
            else:
                (joined if t[0] in b" \t\n\x0b\x0c\r" and not DOUBTFUL[t[-1]] else alone).append(k)
        groups = [joined[i : i + GROUP] for i in range(0, len(joined), GROUP)]
        glue = f" {MARK} " if self.drops_space else ""
        whole = [glue.join(texts[k].decode() for k in g) for g in groups]
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids if self.drops_space else None
        for a in range(0, len(groups), 256):
            for g, e in zip(groups[a : a + 256], self.tokenizer.encode_batch(whole[a : a + 256], add_special_tokens=False)):
                ids = np.array(e.ids, np.uint32)
                if self.drops_space:
                    at = np.flatnonzero(ids == mark[0])
                    parts = [ids[x + 1 : y] for x, y in zip([-1, *at.tolist()], [*at.tolist(), len(ids)])]
                else:
                    ends = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum([len(texts[k]) for k in g])) + 1
                    parts = [ids[x:y] for x, y in zip([0, *ends[:-1].tolist()], ends.tolist())]
                if len(parts) != len(g):
                    raise AssertionError("a piece was joined to its neighbour")
                for k, p in zip(g, parts):
                    found[k] = p
        for k, e in zip(alone, self.tokenizer.encode_batch([texts[k].decode() for k in alone], add_special_tokens=False)):
            found[k] = np.array(e.ids, np.uint32)
        size = np.array([len(p) for p in found], np.int32)
        start = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, *found])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.start, self.size = np.insert(self.keys, at, keys), np.insert(self.start, at, start), np.insert(self.size, at, size)

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, and where each text's ids begin (one more entry than texts)."""
        start, stop, hashes, first = self._pieces(raw, offsets)
        keys, where, at = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > self.most:
            self.clear()
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == keys[inside]
        if not known.all():
            data = raw.tobytes()
            new = where[~known]
            self._learn(keys[~known], [data[a:b] for a, b in zip(start[new].tolist(), stop[new].tolist())])
            place = np.searchsorted(self.keys, keys)
        size = self.size[place][at].astype(np.int64)
        ids = self.ids[A.ranges(self.start[place][at], size)]
        return ids, np.r_[0, np.cumsum(size)][first]
