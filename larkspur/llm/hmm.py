"""Language-model scoring with a hidden Markov model over words.

A state emits words: with share 1 - ``KEPT`` by the expected counts (word, state) of the training texts, with share ``KEPT`` by
the smoothed share of the word in all training texts; unseen words have the probability that the plain word shares give one, in every
state.  The first counts of a word are dealt over the states by its hash.  Baum-Welch passes run over all training texts, whole: a text is cut into
windows of ``WINDOW`` words, each becomes a matrix of scaled forward weights, and the products of these matrices carry
the forward and backward vectors over the cuts, so no text starts anew inside.  Scoring is the scaled forward recursion, exact in the same way.

The table of words and states grows with the corpus and never meets in one place.  Texts are tokenised once, where they are read, in chunks of
``CHUNK`` bytes; words are kept as places in the list of the chunk's distinct words.  Each chunk asks for its distinct words, which are
dealt by hash range.  A training pass is one exchange there and back: the expected counts of a chunk's words go to the ranges, are summed by word, and
the sums go back to the chunks in the order asked.  Both are sent as shares of the word's exact count, in steps of 1/255; the
emissions are those of the shares that were sent, so they add up to 1.  The driver sees totals by state and moves between states alone.

Edge cases: null and empty texts consist of the end token alone; rows with a null id take no part; repeated ids: every row has
its result; with no training text every word is unknown and has probability 1, as in the base score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from larkspur.llm import arrays as A
from larkspur.llm.tables import buckets_for, cut, release_shuffles, text_of

STATES, WINDOW, ROUNDS = 6, 256, 3
KEPT = 0.1
STAY = 0.98  # share of the first moves that stay in a state
END = A.mix(np.array([0xE0D], A.U))[0]  # the hash that stands for the end token
HELD_OUT = 2
AT_ONCE = 1 << 8  # windows taken at once, more where they are short
CHUNK = 1 << 26  # bytes of texts in a chunk; a longer text stands alone
STEPS = 255  # a word's count is dealt over the states in so many parts
TOKENS = 1 << 19  # tokens of texts taken at once


CELLS = STATES + STATES**2  # first states and moves


@dataclass
class Model:
    start: np.ndarray  # state
    move: np.ndarray  # state, next state
    totals: np.ndarray  # expected words of a state
    words: int  # training tokens
    kinds: int  # distinct ones

    @property
    def unknown(self) -> float:
        return 1 / (self.words + self.kinds + 1)


def first_model(totals: np.ndarray, words: int, kinds: int) -> Model:
    """States that mostly stay as they are."""
    move = STAY * np.eye(STATES) + (1 - STAY) / STATES
    return Model(np.full(STATES, 1 / STATES), move, totals, words, kinds)


def first_counts(hashes: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Training counts of words, dealt over the states by a draw from the word's hash: word, state."""
    draws = np.column_stack([(A.mix(hashes + A.U(s + 1)) >> A.U(40)).astype(np.float64) / 2**24 for s in range(STATES)])
    draws += 0.5
    return times[:, None] * draws / draws.sum(axis=1, keepdims=True)


def emissions(model: Model, counts: np.ndarray) -> np.ndarray:
    """Probability of each word in each state, from its expected counts; they add up to its training count."""
    times = np.rint(counts.sum(axis=1))
    shares = ((times + 1) * model.unknown)[:, None]
    own = counts * ((1 - model.unknown) / np.maximum(model.totals, 1e-300))
    out = np.where(model.totals > 0, (1 - KEPT) * own + KEPT * shares, shares)
    out[times == 0] = model.unknown
    return out


def held_out(ids: np.ndarray) -> np.ndarray:
    import zlib

    return np.array([zlib.crc32(b"%d" % i) % 7 == HELD_OUT for i in ids.tolist()], bool)


@dataclass
class Windows:
    """Windows of texts that follow each other, text by text."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    opens: np.ndarray  # the first one of its text
    count: np.ndarray  # by text

    @classmethod
    def of(cls, lengths: np.ndarray) -> Windows:
        n = -(-lengths // WINDOW)
        text, number = np.repeat(np.arange(len(lengths)), n), A.runs(n)
        start = (np.cumsum(lengths) - lengths)[text] + number * WINDOW
        return cls(text, start, np.minimum(WINDOW, lengths[text] - number * WINDOW), number == 0, n)


def alive(lengths: np.ndarray, t: int) -> int:
    """How many of windows in falling order of length are longer than t."""
    return int(np.searchsorted(-lengths, -t, "left"))


def matrices(model: Model, emit: np.ndarray, symbols: np.ndarray, start: np.ndarray, length: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """The forward weights of windows, each up to a factor: state before, state at its end."""
    states = len(model.start)
    out = np.empty((len(start), states, states))
    order = np.argsort(-length, kind="stable")
    for a in range(0, len(order), AT_ONCE):
        part = order[a : a + AT_ONCE]
        s, n_of = start[part], length[part]
        m = np.broadcast_to(np.eye(states), (len(s), states, states)).copy()
        for t in range(int(n_of[0])):
            n = alive(n_of, t)
            step = (m[:n].reshape(-1, states) @ model.move).reshape(n, states, states)
            if t == 0:
                step[opens[part]] = np.eye(states)  # the first word of a text needs no move before it
            step *= emit[symbols[s[:n] + t]][:, None, :]
            if t % 8 == 7:
                step /= step.max(axis=(1, 2))[:, None, None]
            m[:n] = step
        out[part] = m / m.max(axis=(1, 2))[:, None, None]
    return out


def carried(model: Model, emit: np.ndarray, symbols: np.ndarray, w: Windows, both: bool) -> tuple[np.ndarray, np.ndarray]:
    """The state vector before each window, and the weights of the states after it (ones unless ``both``)."""
    states = len(model.start)
    ahead, behind = np.tile(model.start, (len(w.text), 1)), np.ones((len(w.text), states))
    many = w.count > 1
    inside = np.flatnonzero(many[w.text])
    m = matrices(model, emit, symbols, w.start[inside], w.length[inside], w.opens[inside])
    count = np.sort(w.count[many])[::-1]
    first = np.searchsorted(w.text[inside], np.flatnonzero(many)[np.argsort(-w.count[many], kind="stable")])
    vector, weight = np.tile(model.start, (len(count), 1)), np.ones((len(count), states))
    steps = int(count[0]) if len(count) else 0
    for k in range(steps):
        n = alive(count, k)
        at = first[:n] + k
        ahead[inside[at]] = vector[:n]
        v = np.einsum("ns,nst->nt", vector[:n], m[at])
        vector[:n] = v / v.sum(axis=1, keepdims=True)
    for k in range(steps - 1 if both else -1, -1, -1):
        n = alive(count, k)
        at = first[:n] + k
        behind[inside[at]] = weight[:n]
        r = np.einsum("nst,nt->ns", m[at], weight[:n])
        weight[:n] = r / r.max(axis=1, keepdims=True)
    return ahead, behind


def sweep(model: Model, emit: np.ndarray, symbols: np.ndarray, lengths: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability of each text; expected first states and moves in one vector, and those of words added to ``counts``."""
    states = len(model.start)
    w = Windows.of(lengths)
    before, after = carried(model, emit, symbols, w, counts is not None)
    log, first, moves = np.zeros(len(w.text)), np.zeros(states), np.zeros((states, states))
    order = np.argsort(-w.length, kind="stable")
    i = 0
    while i < len(order):
        part = order[i : i + max(AT_ONCE, AT_ONCE * WINDOW // int(w.length[order[i]]))]  # as many words at most
        i += len(part)
        start, length, opens = w.start[part], w.length[part], w.opens[part]
        total, a = np.zeros(len(part)), before[part]
        ahead, seen, given = [], [], []
        for t in range(int(length[0])):
            n = alive(length, t)
            x = symbols[start[:n] + t]
            a = a[:n] @ model.move
            if t == 0:
                a[opens] = before[part][opens]
            e = emit[x]
            a = a * e
            c = a.sum(axis=1, keepdims=True)
            a = a / c
            total[:n] += np.log(c[:, 0])
            if counts is not None:
                ahead.append(a)
                seen.append(x)
                given.append(e / c)
        log[part] = total
        if counts is None:
            continue
        b, state = np.zeros((0, states)), []
        for t in range(len(ahead) - 1, -1, -1):
            n, m = len(ahead[t]), len(b)
            if m:
                weighted = given[t + 1] * b
                moves += ahead[t][:m].T @ weighted
                b = weighted @ model.move.T
            if n > m:  # windows that end here
                end = after[part[m:n]]
                b = np.concatenate([b, end / (ahead[t][m:] * end).sum(axis=1, keepdims=True)])
            state.append(ahead[t] * b)
        first += state[-1][opens].sum(axis=0)
        goes_on = ~opens
        moves += before[part[goes_on]].T @ (given[0] * b)[goes_on]
        del ahead, given
        x, state = np.concatenate(seen[::-1]), np.concatenate(state)
        for s in range(states):
            counts[:, s] += np.bincount(x, state[:, s], len(counts))
    return np.bincount(w.text, log, len(lengths)) / np.log(10), np.concatenate([first, (moves * model.move).ravel()])


def trained(model: Model, cells: np.ndarray, totals: np.ndarray) -> Model:
    """The model of summed first states and moves, each smoothed by a small constant."""
    states = len(model.start)
    first, moves = cells[:states] + 1e-3, cells[states:].reshape(states, states) + 1e-3
    return Model(first / first.sum(), moves / moves.sum(axis=1, keepdims=True), totals, model.words, model.kinds)


def _tokens(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every token, and the number of tokens of each text; a text ends with an end token."""
    raw, offsets = A.flat(table["text"])
    parts, counts = [np.zeros(0, A.U)], [np.zeros(0, np.int64)]
    for i, j in A.slices(offsets):
        low = A.LOWER[raw[offsets[i] : offsets[j]]]
        w = A.words(low, offsets[i : j + 1] - offsets[i])
        parts.append(np.insert(w.hash, w.first[1:], END))
        counts.append(w.counts + 1)
    return np.concatenate(parts), np.concatenate(counts).astype(np.int64)


ASKED = pa.schema([
    ("chunk", pa.int64()), ("bucket", pa.int32()), ("hash", pa.binary()), ("times", pa.binary()),
    ("ids", pa.binary()), ("lengths", pa.binary()), ("planes", pa.list_(pa.binary())),
])
ASKED_SQL = "chunk long, bucket int, hash binary, times binary, ids binary, lengths binary, planes array<binary>"
COUNTS = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("counts", pa.binary()), ("cells", pa.binary())])
COUNTS_SQL = "chunk long, bucket int, counts binary, cells binary"
SUMS = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("sums", pa.binary()), ("totals", pa.binary()), ("places", pa.binary()), ("times", pa.binary())])
SUMS_SQL = "chunk long, bucket int, sums binary, totals binary, places binary, times binary"
SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def planes(values: np.ndarray) -> list[bytes]:
    """Numbers byte by byte, the lowest bytes first: the upper ones are mostly zero and compress away."""
    return [p.tobytes() for p in values.view(np.uint8).reshape(len(values), values.itemsize).T]


def packed(values: np.ndarray) -> bytes:
    return b"".join(planes(values))


def unpacked(blobs: list[bytes], dtype: object) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.concatenate([np.zeros(0, dtype), *(np.frombuffer(b, np.uint8).reshape(size, -1).T.copy().view(dtype).ravel() for b in blobs)])


def shares(counts: np.ndarray) -> np.ndarray:
    """Counts of words by state as parts of ``STEPS``."""
    return np.rint(STEPS * counts / np.maximum(counts.sum(axis=1, keepdims=True), 1e-300)).astype(np.uint8)


def dealt(times: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Counts of words dealt over the states by such parts."""
    return times[:, None] * (parts / np.maximum(parts.sum(axis=1, keepdims=True, dtype=np.int64), 1))


def ask(ids: np.ndarray, texts: pa.Array, chunk: int, buckets: int) -> pa.Table:
    """A chunk's distinct words with their training counts, by hash range; and one row of its texts as places in the list of these words."""
    hashes, lengths = _tokens(pa.table({"text": texts}))
    unique = np.unique(hashes)
    at = np.searchsorted(unique, hashes).astype(np.uint32)
    del hashes
    times = np.bincount(at[np.repeat(~held_out(ids), lengths)], minlength=len(unique)).astype(np.uint32)
    asked = A.scatter((unique >> A.U(32)).astype(np.int64) * buckets >> 32, {"hash": unique, "times": times}, {"chunk": chunk}).to_pylist()
    row = {"chunk": chunk, "bucket": -1, "ids": ids.tobytes(), "lengths": lengths.tobytes(), "planes": planes(at)}
    return pa.Table.from_pylist([*asked, row], ASKED)


def asking(docs: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def chunk() -> list[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            return ask(table["doc_id"].to_numpy(), table["text"].cast(pa.large_string()), number, buckets).to_batches()

        for batch in batches:
            _, offsets = A.flat(batch["text"])
            for i, j in A.slices(offsets, CHUNK):
                more = int(offsets[j] - offsets[i])
                if held and size + more > CHUNK:
                    yield from chunk()
                    number, held, size = number + 1, [], 0
                held.append(batch.slice(i, j - i))
                size += more
        if held:
            yield from chunk()

    return docs.select("doc_id", "text").mapInArrow(run, ASKED_SQL)


@dataclass
class Chunk:
    ids: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> Chunk:
        row = table.to_pylist()[0]
        columns = np.stack([np.frombuffer(p, np.uint8) for p in row["planes"]], axis=1)
        return cls(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["lengths"], np.int64), columns.view(np.uint32).ravel())

    def slices(self, texts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Some texts at a time: which, their symbols, their lengths."""
        begin = np.cumsum(self.lengths) - self.lengths
        which = np.flatnonzero(texts)
        for i, j in A.slices(np.r_[0, np.cumsum(self.lengths[which])], TOKENS):
            part = which[i:j]
            yield part, self.symbols[A.ranges(begin[part], self.lengths[part])], self.lengths[part]


def answers(bucket: int, chunks: list[int], sizes: list[int], at: np.ndarray, times: np.ndarray, sums: np.ndarray, cells: np.ndarray) -> list[dict]:
    """Rows for the chunks, in the order asked, and one of totals (chunk -1): by state, training words, distinct ones, then cells."""
    parts = shares(sums)
    totals = np.r_[dealt(times, parts).sum(axis=0), times.sum(), (times > 0).sum(), cells]
    rows, stops = [{"chunk": -1, "bucket": bucket, "sums": totals.tobytes()}], np.cumsum(sizes).tolist()
    for chunk, a, b in zip(chunks, [0, *stops[:-1]], stops):
        rows.append({"chunk": chunk, "bucket": bucket, "sums": parts[at[a:b]].tobytes(), "totals": packed(times[at[a:b]])})
    return rows


def index(table: pa.Table) -> pa.Table:
    """First answers of a range; what it has to know in later passes stands beside them: places of the words asked for, as steps, and their counts."""
    table = table.sort_by("chunk")
    bucket, sizes = table["bucket"][0].as_py(), [len(h) // 8 for h in table["hash"].to_pylist()]
    unique, at = np.unique(A.gather(table, "hash", np.uint64), return_inverse=True)
    sent = A.gather(table, "times", np.uint32)
    times = np.bincount(at, sent, len(unique)).astype(np.int64)
    rows = answers(bucket, table["chunk"].to_pylist(), sizes, at, times, first_counts(unique, times), np.zeros(CELLS))
    stops = np.cumsum(sizes).tolist()
    for row, a, b in zip(rows[1:], [0, *stops[:-1]], stops):
        row["places"], row["times"] = packed(np.diff(at[a:b], prepend=0).astype(np.uint32)), packed(sent[a:b])
    return pa.Table.from_pylist(rows, SUMS)


def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums of a range by word from the counts that the chunks sent."""
    left, right = left.sort_by("chunk"), right.sort_by("chunk")
    steps = [unpacked([p], np.uint32) for p in left["places"].to_pylist()]
    at = np.concatenate([np.cumsum(x, dtype=np.int64) for x in steps])
    sent = unpacked(left["times"].to_pylist(), np.uint32)
    counts = dealt(sent, A.gather(right, "counts", np.uint8).reshape(-1, STATES))
    n = int(at.max()) + 1
    sums = np.column_stack([np.bincount(at, counts[:, s], n) for s in range(STATES)])
    cells = sum((np.frombuffer(c) for c in right["cells"].to_pylist() if c is not None), np.zeros(CELLS))
    return pa.Table.from_pylist(answers(left["bucket"][0].as_py(), left["chunk"].to_pylist(), list(map(len, steps)), at, np.bincount(at, sent, n).astype(np.int64), sums, cells), SUMS)


def told(chunk: pa.Table, sums: pa.Table, model: Model) -> tuple[Chunk, np.ndarray, np.ndarray]:
    """A chunk, the training counts of its words, their emissions."""
    times = unpacked(sums["totals"].to_pylist(), np.int64)
    return Chunk.of(chunk), times, emissions(model, dealt(times, A.gather(sums, "sums", np.uint8).reshape(-1, STATES)))


def expect(left: pa.Table, right: pa.Table, model: Model) -> pa.Table:
    """Expected counts of a chunk's words for each range; its first states and moves go with the first one."""
    right = right.sort_by("bucket")
    chunk, _, emit = told(left, right, model)
    counts, cells = np.zeros(emit.shape), np.zeros(CELLS)
    for _, symbols, lengths in chunk.slices(~held_out(chunk.ids)):
        cells += sweep(model, emit, symbols, lengths, counts)[1]
    parts, rows, a = shares(counts), [], 0
    for bucket, sums in zip(right["bucket"].to_pylist(), right["sums"].to_pylist()):
        b = a + len(sums) // STATES
        rows.append({"chunk": left["chunk"][0].as_py(), "bucket": bucket, "counts": parts[a:b].tobytes(), "cells": None if a else cells.tobytes()})
        a = b
    return pa.Table.from_pylist(rows, COUNTS)


def judge(left: pa.Table, right: pa.Table, model: Model) -> pa.Table:
    """Base score and model score of a chunk's texts."""
    chunk, times, emit = told(left, right.sort_by("bucket"), model)
    base_of = np.log10((times + 1) / (model.words + model.kinds + 1))
    n = len(chunk.ids)
    known, base, score = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
    for which, symbols, lengths in chunk.slices(np.ones(n, bool)):
        text = np.repeat(np.arange(len(which)), lengths)
        known[which] = np.bincount(text[times[symbols] > 0], minlength=len(which))
        base[which] = np.bincount(text, base_of[symbols], len(which))
        score[which] = sweep(model, emit, symbols, lengths)[0]
    return pa.table([chunk.ids, held_out(chunk.ids), chunk.lengths, known, np.full(n, model.words, np.int64), base, score], schema=SCORED)


def _totals(sums: DataFrame) -> np.ndarray:
    """Sum of the totals of all ranges; one row for each cell reaches the driver."""
    cells = STATES + 2 + CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells)
        for batch in batches:
            for blob in batch["sums"].to_pylist():
                total = total + np.frombuffer(blob)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells, dtype=np.int32)), pa.array(total)], ["cell", "value"])

    out = np.zeros(cells)
    for r in sums.where("chunk < 0").select("sums").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect():
        out[r.cell] = r.value
    return out


def score_documents(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Base score and model score of every document."""
    spark, docs = docs.sparkSession, text_of(docs)
    buckets = buckets_for(docs, 2)
    asked = cut(asking(docs, buckets))
    texts = asked.where("bucket < 0").select("chunk", "ids", "lengths", "planes")
    sums = cut(asked.where("bucket >= 0").select("chunk", "bucket", "hash", "times").groupBy("bucket").applyInArrow(index, SUMS_SQL))
    release_shuffles(spark)
    known = sums.where("chunk >= 0").select("chunk", "bucket", "places", "times")

    def by_chunk(work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        told_back = sums.where("chunk >= 0").select("chunk", "bucket", "sums", "totals")
        return texts.groupBy("chunk").cogroup(told_back.groupBy("chunk")).applyInArrow(work, schema)

    totals = _totals(sums)
    model = first_model(totals[:STATES], int(totals[STATES]), int(totals[STATES + 1]))
    for _ in range(rounds):
        counts = by_chunk(lambda a, b: expect(a, b, model), COUNTS_SQL)
        sums = cut(known.groupBy("bucket").cogroup(counts.groupBy("bucket")).applyInArrow(add_up, SUMS_SQL))
        del counts
        release_shuffles(spark)
        totals = _totals(sums)
        model = trained(model, totals[STATES + 2 :], totals[:STATES])
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return by_chunk(lambda a, b: judge(a, b, model), schema)
