"""SentencePiece encoding and decoding of whole texts: a max-plus scan over the pieces of a BPE model.

The scores of the model file are merge ranks, so the ids are not those of the best sum of scores but those of the merges: of all neighbours that
make up a piece, those with the best score (ties: the leftmost) are merged, until none are left.  As a max-plus problem: **a sequence of pieces is
what the merges give if and only if every two neighbours, taken alone, merge to just these two.**  (Inside two neighbours the merges of the whole
text are those of the two alone, as each is the best one there; and the first merge over a border of the sequence would be the best one of the two
pieces it touches as well.)  So a step from piece to piece counts the score of the new piece where the two hold, and minus infinity elsewhere; exactly
one path runs through a whole text.

Texts longer than ``CHUNK`` characters are cut every ``CHUNK`` characters, wherever that is, and the chunks are dealt out:

1. The state at a border is the piece over it, or the one that ends there: (its start, its end).  Both sides of a border see enough text to list the same
   states.  Each chunk yields the matrix of scores from the states at its first border to those at its last.
2. Matrices are combined associatively, ``FAN`` neighbours in a group, level by level; going back down, each group learns its own states.
3. Each chunk, told its two states, is traced back by itself and gives the pieces that start in it.

No merge reaches over the start of a space after another character.  So a chunk's matrix comes from the scan up to the first such place and from the
last one on; stretches between are merged once for each distinct one per worker, as are those of texts that fit in a chunk.  A chunk without such
a place is scanned as a whole.  Characters that no piece holds fall back to bytes.  The ids are those of the library.

Edge cases: null and empty texts have no tokens; repeated ids are kept apart by their text; rows with a null id are left out.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larkspur.llm import arrays as A
from larkspur.llm.tables import cut, text_of
from larkspur.llm.tokens import Encoder, worker_store

CHUNK = 1 << 16
FAN = 64  # matrices combined in one group
NEVER = -1e300
SPACE = "▁"
SHORT = 48  # longer stretches are merged one by one
TOGETHER = 1 << 16  # characters of short stretches merged at once
PAIRS = 1_000_000  # neighbours remembered by a worker

#: The start of a space after another character.
FREE = re.compile(f"(?<=[^{SPACE}]){SPACE}")
Span = tuple[int, int]


class Pieces(Encoder):
    """The vocabulary of a SentencePiece model file, and a store of merged stretches."""

    most = 1_500_000

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.piece, self.scores, self.byte = {}, {}, {}
        self.text: list[bytes] = [b""] * size
        for k in range(size):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                self.byte[int(piece[1:-1], 16)] = k
                self.text[k] = bytes([int(piece[1:-1], 16)])
            elif not (model.is_control(k) or model.is_unknown(k)):
                self.piece[piece], self.scores[piece] = k, model.get_score(k)
                self.text[k] = piece.replace(SPACE, " ").encode()
        if any(SPACE in p.lstrip(SPACE) for p in self.scores):
            raise ValueError("pieces hold a space after another character")
        self.longest = max(map(len, self.scores))
        self.unknown = min(self.scores.values()) - 10
        keys = [np.array([self._key(p) for p in self.scores], A.U), np.array(list(self.scores.values()))]
        order = np.argsort(keys[0])
        self.keys_of, self.score_of, self.id_of = keys[0][order], keys[1][order], np.array(list(self.piece.values()))[order]
        bits = 20
        self.table, self.shift = np.full(1 << bits, -1, np.int32), A.U(64 - bits)
        self.table[self.keys_of >> self.shift] = np.arange(len(order))
        self.crowded = np.setdiff1d(np.arange(len(order)), self.table)  # entries that lost their slot
        self.begins = {p[:k] for p in self.scores for k in range(1, len(p) + 1)}
        self.known: dict[tuple[str, str], bool] = {}
        self.clear()

    @staticmethod
    def _values(text: str) -> np.ndarray:
        return A.mix(np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(A.U) + A.U(1))

    def _key(self, piece: str) -> int:
        return int(A.Spans(self._values(piece)).hash(np.array([0]), np.array([len(piece)]))[0])

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Entries of spans by hash, -1 where there is no such piece."""
        at = self.table[keys >> self.shift].astype(np.int64)
        rest = np.flatnonzero(self.keys_of[at] != keys)
        if len(self.crowded) and len(rest):
            place = np.minimum(np.searchsorted(self.keys_of[self.crowded], keys[rest]), len(self.crowded) - 1)
            found = self.keys_of[self.crowded][place] == keys[rest]
            at[rest] = np.where(found, self.crowded[place], -1)
        else:
            at[rest] = -1
        return at

    def forward(self, text: str, begin: list[float], stop: int) -> tuple[list[float], list[int]]:
        """The pieces of ``text[:stop]``: the score at each place where one ends, from the score of the first place, and the place before."""
        text, scores = text[:stop], self.scores
        n = len(text)
        ends, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the symbol that starts at a place; end 0: it was merged
        heap = [(-scores[text[p : p + 2]], p, p + 2) for p in range(n - 1) if text[p : p + 2] in scores]
        heapq.heapify(heap)
        while heap:
            _, p, q = heapq.heappop(heap)
            middle = ends[p]
            if not 0 < middle < q or ends[middle] != q:
                continue
            ends[p], ends[middle] = q, 0
            if q < n:
                before[q] = p
                s = scores.get(text[p : ends[q]]) if ends[q] - p <= self.longest else None
                if s is not None:
                    heapq.heappush(heap, (-s, p, ends[q]))
            b = before[p]
            if b >= 0 and q - b <= self.longest:
                s = scores.get(text[b:q])
                if s is not None:
                    heapq.heappush(heap, (-s, b, q))
        best, back = [NEVER] * (n + 1), [-1] * (n + 1)
        best[0], p = begin[0], 0
        while p < n:
            q = ends[p]
            best[q], back[q] = best[p] + scores.get(text[p:q], self.unknown), p
            p = q
        return best, back

    def traced(self, text: str, back: list[int], place: int) -> list[int]:
        """Ids of the pieces up to a place."""
        out = []
        while back[place] >= 0:
            part = text[back[place] : place]
            k = self.piece.get(part)
            out += [k] if k is not None else [self.byte[b] for b in reversed(part.encode())]
            place = back[place]
        return out[::-1]

    def _pieces(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Stretches between starts of spaces."""
        space = raw == 32
        begins = np.zeros(len(raw), bool)
        begins[1:] = space[1:] & ~space[:-1]
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        start = np.flatnonzero(begins)
        stop = np.r_[start[1:], len(raw)] if len(start) else start
        return start, stop, A.Spans(A.WEIGHT[raw]).hash(start, stop), np.searchsorted(start, offsets)

    def _learn(self, keys: np.ndarray, texts: list[bytes]) -> None:
        strings = [t.decode().replace(" ", SPACE) for t in texts]
        found: list[list[int]] = [[]] * len(texts)
        short = [k for k, s in enumerate(strings) if len(s) <= SHORT]
        for k, s in enumerate(strings):
            if len(s) > SHORT:
                _, back = self.forward(s, [0.0], len(s))
                found[k] = self.traced(s, back, len(s))
        block = np.cumsum([len(strings[k]) for k in short]) // TOGETHER
        for b in np.unique(block).tolist():
            i, j = np.searchsorted(block, [b, b + 1]).tolist()
            self._together([strings[k] for k in short[i:j]], short[i:j], found)
        size = np.array([len(p) for p in found], np.int32)
        start = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, np.array([i for p in found for i in p], np.uint32)])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.start, self.size = np.insert(self.keys, at, keys), np.insert(self.start, at, start), np.insert(self.size, at, size)

    def _together(self, strings: list[str], where: list[int], found: list[list[int]]) -> None:
        """Merge many short stretches at once, one pair of each at a time."""
        text = "".join(strings)
        sizes = np.array([len(s) for s in strings])
        spans = A.Spans(self._values(text))
        start, lane = np.arange(len(text)), np.repeat(np.arange(len(strings)), sizes)
        stop = start + 1

        def scores(at: np.ndarray) -> np.ndarray:
            """Scores of the symbols with the ones after them."""
            out = np.full(len(at), NEVER)
            ok = np.flatnonzero(at + 1 < len(lane))
            ok = ok[lane[at[ok]] == lane[at[ok] + 1]]
            entry = self.lookup(spans.hash(start[at[ok]], stop[at[ok] + 1]))
            out[ok] = np.where(entry >= 0, self.score_of[entry], NEVER)
            return out

        pair = scores(np.arange(len(start)))
        done = []
        while len(start):
            head = np.flatnonzero(np.r_[True, lane[1:] != lane[:-1]])
            counts = np.diff(np.r_[head, len(lane)])
            top = np.repeat(np.maximum.reduceat(pair, head), counts)
            ready = top <= NEVER / 2
            if ready.any():
                done.append((start[ready], stop[ready], lane[ready]))
                start, stop, lane, pair, top = (x[~ready] for x in (start, stop, lane, pair, top))
            at = np.flatnonzero(pair == top)
            at = at[np.r_[True, lane[at[1:]] != lane[at[:-1]]]] if len(at) else at
            stop[at] = stop[at + 1]
            keep = np.ones(len(start), bool)
            keep[at + 1] = False
            start, stop, lane, pair = (x[keep] for x in (start, stop, lane, pair))
            at = at - np.arange(len(at))  # one symbol fewer for each merge before
            changed = np.union1d(at, at[at > 0] - 1)
            pair[changed] = scores(changed)
        start, stop, lane = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(start)
        start, stop, lane = start[order], stop[order], lane[order]
        entry = self.lookup(spans.hash(start, stop))
        ids = np.where(entry >= 0, self.id_of[entry], -1).tolist()
        cuts = np.searchsorted(lane, np.arange(len(strings) + 1)).tolist()
        for k, a, b in zip(where, cuts[:-1], cuts[1:]):
            part = ids[a:b]
            if -1 in part:
                part = [i for c, k_ in zip(range(a, b), part) for i in ([k_] if k_ >= 0 else [self.byte[x] for x in text[start[c] : stop[c]].encode()])]
            found[k] = part

    def score(self, ids: np.ndarray) -> float:
        """Sum of scores; a character in bytes counts once."""
        if not hasattr(self, "id_scores"):
            self.id_scores = np.zeros(len(self.text))
            self.is_byte, self.leads = np.zeros(len(self.text), bool), np.zeros(len(self.text), bool)
            for p, k in self.piece.items():
                self.id_scores[k] = self.scores[p]
            for b, k in self.byte.items():
                self.is_byte[k], self.leads[k] = True, (b & 0xC0) != 0x80
                self.id_scores[k] = self.unknown if (b & 0xC0) != 0x80 else 0
        return float(self.id_scores[ids].sum())

    def encode_text(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.replace(SPACE, " ").encode(), np.uint8) if SPACE in text else np.frombuffer(text.encode(), np.uint8)
        return self.encode(raw, np.array([0, len(raw)]))[0]

    def stays(self, first: str, second: str) -> bool:
        """Whether two pieces merge to just these two; an empty first one asks for the second alone."""
        found = self.known.get((first, second))
        if found is None:
            if len(self.known) >= PAIRS:
                self.known.clear()
            both = first + second
            _, back = self.forward(both, [0.0], len(both))
            found = back[len(both)] == len(first) and (not first or back[len(first)] == 0)
            self.known[first, second] = found
        return found

    def states(self, text: str, border: int) -> list[Span]:
        """Pieces that may lie over a border or end there; at the start of the text there is one state, no piece."""
        if border == 0:
            return [(0, 0)]
        spans = []
        for a in range(max(0, border - self.longest), border):
            for b in range(a + 1, min(len(text), a + self.longest) + 1):
                if text[a:b] not in self.begins and b > a + 1:
                    break
                if b >= border and self.holds(text, a, b):
                    spans.append((a, b))
        return spans

    def holds(self, text: str, a: int, b: int) -> bool:
        return (b == a + 1 or text[a:b] in self.scores) and self.stays("", text[a:b])

    def scan(self, text: str, entries: list[Span], stop: int) -> tuple[dict[Span, np.ndarray], dict[Span, int]]:
        """From the states at a border to the pieces that reach ``stop``: scores by entry, and for each piece the start of the one before.

        With one entry the piece before is unique.
        """
        live: dict[int, dict[int, np.ndarray]] = {}
        reached: dict[Span, np.ndarray] = {}
        back: dict[Span, int] = {}
        for k, (a, b) in enumerate(entries):
            start = np.full(len(entries), NEVER)
            start[k] = 0.0
            if b >= stop:
                reached[a, b] = start
            else:
                live.setdefault(b, {})[a] = start
        low = min(live, default=stop)
        for p in range(low, stop):
            nodes = live.pop(p, None)
            if not nodes:
                continue
            before = [(a, text[a:p], values) for a, values in nodes.items()]
            for q in range(p + 1, min(len(text), p + self.longest) + 1):
                part = text[p:q]
                if part not in self.begins and q > p + 1:
                    break
                score = self.scores.get(part)
                if score is None:
                    if q > p + 1:
                        continue
                    score = self.unknown
                best = None
                for a, last, values in before:
                    if self.stays(last, part):
                        best = values if best is None else np.maximum(best, values)
                        back[p, q] = a
                if best is not None:
                    best = np.where(best > NEVER / 2, best + score, NEVER)
                    if q >= stop:
                        reached[p, q] = best
                    else:
                        live.setdefault(q, {})[p] = best
        return reached, back

    @staticmethod
    def free(text: str, low: int, high: int) -> Span | None:
        """The first and the last start of a space after another character, from low to high (without high)."""
        found = FREE.search(text, low, high)
        if found is None:
            return None
        return found.start(), next(p for p in range(high - 1, -1, -1) if FREE.match(text, p))

    def transfer(self, text: str, low: int, high: int) -> np.ndarray:
        """Scores from the states at ``low`` to those at ``high``."""
        entries, exits = self.states(text, low), self.states(text, high)
        place = {span: k for k, span in enumerate(exits)}
        out = np.full((len(entries), len(exits)), NEVER)
        free = self.free(text, low, high)
        if free is None:
            for span, values in self.scan(text, entries, high)[0].items():
                out[:, place[span]] = values
            return out
        head = np.full(len(entries), NEVER)
        for values in self.scan(text, entries, free[0])[0].values():
            head = np.maximum(head, values)
        head += self.score(self.encode_text(text[free[0] : free[1]]))
        for span, values in self.scan(text, [(free[1], free[1])], high)[0].items():
            out[:, place[span]] = np.where(head > NEVER / 2, head + values[0], NEVER)
        return out

    def between(self, text: str, entry: Span, exit: Span, back: dict[Span, int]) -> list[int]:
        """Ids of the pieces after one state up to another."""
        out = []
        span = exit
        while span != entry:
            part = text[span[0] : span[1]]
            k = self.piece.get(part)
            out += [k] if k is not None else [self.byte[b] for b in reversed(part.encode())]
            span = back[span], span[0]
        return out[::-1]

    def trace(self, text: str, low: int, high: int, enter: int, leave: int) -> np.ndarray:
        """Ids of the pieces that start from ``low`` to ``high``, between two states."""
        entry, exit = self.states(text, low)[enter], self.states(text, high)[leave]
        free = self.free(text, low, high)
        if free is None:
            return np.array(self.between(text, entry, exit, self.scan(text, [entry], high)[1]), np.uint32)
        reached, back = self.scan(text, [entry], free[0])
        (middle,) = reached
        head = self.between(text, entry, middle, back)
        begin = free[1], free[1]
        tail = self.between(text, begin, exit, self.scan(text, [begin], high)[1])
        return np.concatenate([np.array(head, np.uint32), self.encode_text(text[free[0] : free[1]]), np.array(tail, np.uint32)])


def pieces(path: str) -> Pieces:
    store = worker_store()
    if path not in store:
        store[path] = Pieces(path)
    return store[path]


KEY = ["doc_id", "copy", "chunk"]
KEY_FIELDS = [("doc_id", pa.int64()), ("copy", pa.binary()), ("chunk", pa.int32())]
CHUNKS = "doc_id long, copy binary, chunk int, text string, low int, high int"
CHUNK_SCHEMA = pa.schema([*KEY_FIELDS, ("text", pa.string()), ("low", pa.int32()), ("high", pa.int32())])
MATRICES = "doc_id long, copy binary, chunk int, width int, matrix binary"
MATRIX_SCHEMA = pa.schema([*KEY_FIELDS, ("width", pa.int32()), ("matrix", pa.binary())])
ENDS = "doc_id long, copy binary, chunk int, enter int, leave int"
END_SCHEMA = pa.schema([*KEY_FIELDS, ("enter", pa.int32()), ("leave", pa.int32())])


def chunks(docs: DataFrame, model: str, size: int = CHUNK) -> DataFrame:
    """Texts cut every ``size`` characters, spaces written as pieces have them.

    The chunk is ``text[low:high]``; beside it stand as many characters as a piece may reach over.  ``copy`` tells texts of one id apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = pieces(model).longest
        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                copy = hashlib.md5(text.encode()).digest()
                text = SPACE + text.replace(" ", SPACE) if text else ""
                for k, a in enumerate(range(0, len(text), size)):
                    b, low = min(a + size, len(text)), max(0, a - reach)
                    row = {"doc_id": doc, "copy": copy, "chunk": k, "text": text[low : b + reach], "low": a - low, "high": b - low}
                    yield pa.RecordBatch.from_pylist([row], CHUNK_SCHEMA)

    return text_of(docs).mapInArrow(run, CHUNKS)


def transfers(cut_texts: DataFrame, model: str) -> DataFrame:
    """The matrix of each different chunk: scores as doubles, row by row, ``width`` of them in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model)
        for batch in batches:
            for row in batch.to_pylist():
                matrix = vocabulary.transfer(row["text"], row["low"], row["high"])
                yield pa.RecordBatch.from_pylist([{**{k: row[k] for k in KEY}, "width": matrix.shape[1], "matrix": matrix.tobytes()}], MATRIX_SCHEMA)

    return cut_texts.mapInArrow(run, MATRICES).dropDuplicates(KEY)


def _matrices(group: pa.Table) -> tuple[list[dict], list[np.ndarray]]:
    rows = group.sort_by("chunk").to_pylist()
    return rows, [np.frombuffer(r["matrix"]).reshape(-1, r["width"]) for r in rows]


def times(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The max-plus product; it is associative."""
    return np.maximum(np.max(left[:, :, None] + right[None], axis=1, initial=NEVER), NEVER)


def _product(key: tuple, group: pa.Table) -> pa.Table:
    rows, matrices = _matrices(group)
    out = matrices[0]
    for m in matrices[1:]:
        out = times(out, m)
    return pa.Table.from_pylist([{"doc_id": rows[0]["doc_id"], "copy": rows[0]["copy"], "chunk": rows[0]["chunk"] // FAN, "width": out.shape[1], "matrix": out.tobytes()}], MATRIX_SCHEMA)


def _inner_states(key: tuple, group: pa.Table) -> pa.Table:
    """States at the borders inside a group from those at its ends."""
    rows, matrices = _matrices(group)
    best = [matrices[0][rows[0]["enter"]]]
    for m in matrices[1:]:
        best.append(times(best[-1][None], m)[0])
    leave, out = rows[0]["leave"], []
    for k in range(len(rows) - 1, -1, -1):
        enter = int(np.argmax(best[k - 1] + matrices[k][:, leave])) if k else rows[0]["enter"]
        out.append({**{c: rows[k][c] for c in KEY}, "enter": enter, "leave": leave})
        leave = enter
    return pa.Table.from_pylist(out, END_SCHEMA)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states of whole texts: no piece at the start, the only one reached at the end."""
    for batch in batches:
        out = [{**{k: r[k] for k in KEY}, "enter": 0, "leave": int(np.argmax(np.frombuffer(r["matrix"])[: r["width"]]))} for r in batch.to_pylist()]
        yield pa.RecordBatch.from_pylist(out, END_SCHEMA)


def border_states(matrices: DataFrame, last: int) -> DataFrame:
    """The state at both borders of each chunk: (doc_id, copy, chunk, enter, leave); ``last`` is the highest chunk number."""
    if last == 0:
        return matrices.mapInArrow(_ends, ENDS)
    group = ["doc_id", "copy", "_group"]
    grouped = matrices.withColumn("_group", F.expr(f"chunk div {FAN}").cast("int"))
    above = cut(grouped.groupBy(*group).applyInArrow(_product, MATRICES))
    ends = border_states(above, last // FAN).withColumnRenamed("chunk", "_group")
    return grouped.join(ends, group).groupBy(*group).applyInArrow(_inner_states, ENDS)


ENCODED = "doc_id long, copy binary, chunk int, ids binary, score double"
DECODED = "doc_id long, copy binary, chunk int, n_tokens long, n_byte_tokens long, score double, text binary"
Batches = Iterator[pa.RecordBatch]


def encode(docs: DataFrame, model: str, size: int = CHUNK, after: Callable[[Batches], Batches] | None = None, schema: str = ENCODED) -> DataFrame:
    """Token ids of all texts by chunk: (doc_id, copy, chunk, ids as little-endian unsigned 32-bit integers, score).

    Texts that fit in one chunk, most of them, are encoded straight from the table; only longer ones are cut.  A chunk holds the pieces that start in it.
    ``after`` takes the encoded batches on in the same worker; ``schema`` is then that of its rows.
    """
    after = after or iter
    texts = text_of(docs)
    fits = F.length("text") < size  # one more place goes to the space in front
    giants = texts.where(~fits)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, mark = pieces(model), SPACE.encode()
        for batch in batches:
            raw, offsets = A.flat(batch["text"])
            for i, j in A.slices(offsets):
                data, stops = raw[offsets[i] : offsets[j]].tobytes(), (offsets[i : j + 1] - offsets[i]).tolist()
                each = [data[a:b] for a, b in zip(stops[:-1], stops[1:])]
                spaced = [b" " + t.replace(mark, b" ") if t else t for t in each]
                ids, first = vocabulary.encode(np.frombuffer(b"".join(spaced), np.uint8), np.cumsum([0, *map(len, spaced)]))
                blobs = [ids[a:b].astype("<u4").tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                scores = [vocabulary.score(ids[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                copies = pa.array([hashlib.md5(t).digest() for t in each], pa.binary())
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(i, j - i), copies, pa.array(np.zeros(j - i, np.int32)), pa.array(blobs, pa.binary()), pa.array(scores)], ["doc_id", "copy", "chunk", "ids", "score"])

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model)
        for batch in batches:
            for row in batch.to_pylist():
                ids = vocabulary.trace(row["text"], row["low"], row["high"], row["enter"], row["leave"]).astype("<u4")
                yield pa.RecordBatch.from_pylist([{**{k: row[k] for k in KEY}, "ids": ids.tobytes(), "score": vocabulary.score(ids)}], IDS_SCHEMA)

    encoded = texts.where(fits).mapInArrow(lambda b: after(whole(b)), schema)
    parts = cut(chunks(giants, model, size).repartition(*KEY))
    last = parts.agg(F.max("chunk")).first()[0]
    if last is None:
        return encoded
    states = border_states(cut(transfers(parts, model)), last)
    return encoded.union(parts.join(states, KEY).mapInArrow(lambda b: after(traced(b)), schema))


IDS_SCHEMA = pa.schema([*KEY_FIELDS, ("ids", pa.binary()), ("score", pa.float64())])


def decoder(model: str) -> Callable[[Batches], Batches]:
    """Encoded batches to decoded ones."""

    def run(batches: Batches) -> Batches:
        vocabulary = pieces(model)
        text, is_byte = vocabulary.text, np.zeros(len(vocabulary.text), bool)
        is_byte[list(vocabulary.byte.values())] = True
        for batch in batches:
            all_ids = [np.frombuffer(b.as_buffer(), "<u4") for b in batch["ids"]]
            out = [b"".join(map(text.__getitem__, ids.tolist())) for ids in all_ids]
            out = [t[1:] if k == 0 else t for t, k in zip(out, batch["chunk"].to_pylist())]
            counts = [pa.array([len(i) for i in all_ids], pa.int64()), pa.array([int(is_byte[i].sum()) for i in all_ids], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["copy"], batch["chunk"], *counts, batch["score"], pa.array(out, pa.binary())], ["doc_id", "copy", "chunk", "n_tokens", "n_byte_tokens", "score", "text"])

    return run


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """The bytes of each chunk: (doc_id, copy, chunk, n_tokens, n_byte_tokens, score, text binary); the first chunk of a text loses the space put before it."""
    return encoded.mapInArrow(decoder(model), DECODED)


def round_trip(docs: DataFrame, model: str, size: int = CHUNK) -> DataFrame:
    """Every text encoded and decoded again, in one worker: counts, score, and the bytes that came back.

    One row for each row of the table: the chunks of equal rows meet in one group, which holds as many first chunks as there are rows.
    """
    back = encode(docs, model, size, decoder(model), DECODED)
    rows = F.count_if(F.col("chunk") == 0)
    sums = back.groupBy("doc_id", "copy").agg(
        rows.alias("_rows"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_byte_tokens", "score")),
        F.sum(F.octet_length("text")).alias("n_bytes"), F.count("*").alias("n_chunks"),
    )
    each = [F.floor(F.col(c) / F.col("_rows")).alias(c) for c in ("n_tokens", "n_byte_tokens")]
    each += [(F.col("score") / F.col("_rows")).alias("score"), *(F.floor(F.col(c) / F.col("_rows")).alias(c) for c in ("n_bytes", "n_chunks"))]
    return sums.select("doc_id", F.explode(F.sequence(F.lit(1), F.col("_rows"))).alias("_row"), *each).drop("_row")
