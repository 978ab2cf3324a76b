"""Order-preserving packing of documents into training sequences.

The ids of documents in ascending order of doc_id form a stream, cut into blocks of whole documents.  A sequence is a window of the
stream, at most ``SIZE`` ids; its ends lie at document ends, sentence ends, or (where there is neither for long) at
fixed steps.  Dynamic programming picks the ends with the least padding plus penalties for cut
documents: a window from i to j costs SIZE - (p_j - p_i) and the penalty of j, so the best i for a
j minimises f_i + p_i among the ends at most SIZE back, which a monotone queue keeps at its head.

Edge cases: a null or empty text consists of the end id; documents longer than a sequence are cut; rows
with equal ids follow each other in order of their text; rows with a null id are left out; an empty table gives no pieces.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from larkspur.llm import arrays as A
from larkspur.llm.dac import in_order
from larkspur.llm.tokens import encoder

SIZE = 2048
END_ID = 1
SENTENCE_PENALTY, CUT_PENALTY, STEP = 4, 16, 64
BLOCK_IDS = 1 << 21
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def possible_ends(total: int, doc_ends: np.ndarray, sentence_ends: np.ndarray, size: int = SIZE, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end, ascending, from 0 to total, and their penalties."""
    places = np.concatenate([[0], doc_ends, sentence_ends])
    cost = np.concatenate([[0], np.zeros(len(doc_ends), np.int64), np.full(len(sentence_ends), SENTENCE_PENALTY)])
    order = np.lexsort((cost, places))
    places, cost = places[order], cost[order]
    new = np.r_[True, places[1:] != places[:-1]]
    places, cost = places[new], cost[new]
    step = min(step, size)
    extra = (np.diff(places) - 1) // step
    added = np.repeat(places[:-1], extra) + (A.runs(extra) + 1) * step
    at = np.searchsorted(places, added)
    return np.insert(places, at, added), np.insert(cost, at, CUT_PENALTY)


def best_cuts(places: np.ndarray, cost: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Ends of the cheapest windows, from the first place to the last."""
    p, c = places.tolist(), cost.tolist()
    f, back = [0] * len(p), [0] * len(p)
    queue: deque[tuple[int, int]] = deque([(p[0], 0)])  # (f_i + p_i, i), ascending
    for j in range(1, len(p)):
        here = p[j]
        while p[queue[0][1]] < here - size:
            queue.popleft()
        least, i = queue[0]
        f[j] = value = least + size - here + c[j]
        back[j] = i
        value += here
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    cuts, j = [], len(p) - 1
    while j > 0:
        cuts.append(p[j])
        j = back[j]
    return np.array(cuts[::-1], np.int64)


def pack_block(ids: np.ndarray, doc_ids: np.ndarray, doc_ends: np.ndarray, ends_sentence: np.ndarray, first_sequence: int, size: int = SIZE) -> tuple[pa.RecordBatch, int]:
    """Pieces of a block of whole documents, and the next free sequence."""
    sentence = np.flatnonzero(ends_sentence[ids]) + 1
    cuts = best_cuts(*possible_ends(len(ids), doc_ends, sentence, size), size)
    stops = np.union1d(cuts, doc_ends)
    starts = np.r_[0, stops[:-1]]
    doc = np.searchsorted(doc_ends, stops)
    sequence = np.searchsorted(cuts, stops)
    doc_begins = np.r_[0, doc_ends[:-1]]
    crc = A.crc32_rows(ids.astype("<u4").tobytes(), starts * 4, stops * 4)
    columns = [doc_ids[doc], starts - doc_begins[doc], stops - starts, crc, (doc_ends - doc_begins)[doc], first_sequence + sequence, starts - np.r_[0, cuts[:-1]][sequence]]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], [c.split()[0] for c in PIECES.split(", ")]), first_sequence + len(cuts)


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their places in sequences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = encoder(tokenizer)
        ends_sentence = source.sentence_ends()
        next_sequence = TaskContext.get().partitionId() << 32
        ids_in, docs_in, ends_in, total = [], [], [], 0
        for batch in batches:
            raw, offsets = A.flat(batch["text"])
            doc_ids = batch["doc_id"].to_numpy()
            for i, j in A.slices(offsets):
                ids, first = source.encode(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                ids_in.append(np.insert(ids, first[1:], end_id))
                docs_in.append(doc_ids[i:j])
                ends_in.append(first[1:] + np.arange(1, j - i + 1) + total)
                total += len(ids_in[-1])
                if total >= BLOCK_IDS:
                    out, next_sequence = pack_block(np.concatenate(ids_in), np.concatenate(docs_in), np.concatenate(ends_in), ends_sentence, next_sequence, size)
                    yield out
                    ids_in, docs_in, ends_in, total = [], [], [], 0
        if total:
            yield pack_block(np.concatenate(ids_in), np.concatenate(docs_in), np.concatenate(ends_in), ends_sentence, next_sequence, size)[0]

    return in_order(docs).mapInArrow(run, PIECES)
