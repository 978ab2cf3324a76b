"""Repeated windows across documents: the search that both substring operators start from.

A document is a sequence of elements (bytes, or words by their hashes), a window is ``length`` consecutive
elements.  Every window belongs to its smallest gram of ``gram`` elements (by hash, leftmost on ties), its *anchor*,
so equal windows have equal anchors at equal places.  Consecutive windows with one anchor form a *run*; runs are
some tenths of a document's elements apart, and only their hashes are shuffled.  By anchor:

* runs with the same content: every run but the first is a repeat as a whole;
* runs with the same anchor and other content are *open*: their windows have to be compared.  The text of the first run of
  each content goes on to the comparison, which is what the two operators differ in.
* open runs of a *hot* anchor, one with more than ``most`` contents (a phrase shorter than the window in many documents), are
  dealt on as single windows by the hash of the window, and equal windows are found by sorting them whole.

Hot passages cost one comparison for each different content, not for each copy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from larkspur.llm import arrays as A
from larkspur.llm.tables import bucket_count, cut, fold, fold_array

BLOCK = 1 << 23  # windows taken at once; positions have 24 bits
PLACE = A.U((1 << 24) - 1)
SMALL = 1 << 20  # bytes taken at once
HOT = 1 << 14  # contents of an anchor that one task compares


@dataclass(frozen=True)
class Rule:
    """What counts as a repeat."""

    length: int
    gram: int
    by_words: bool
    same_document: bool  # an earlier place in the same document counts too
    most: int = HOT  # an anchor with more contents is hot

    def __post_init__(self) -> None:
        if self.length - self.gram + 1 > np.iinfo(COLUMNS["n"]).max:
            raise ValueError(f"windows of {self.length} elements: a run of them would have more than 65,535")

    @property
    def run_size(self) -> type:
        """A type for the windows of a run, at most as many as a window has places for its anchor."""
        return np.uint8 if self.length - self.gram + 1 <= 255 else np.uint16

    def elements(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, A.Words | None]:
        """Values to hash, first element of each text, words."""
        if not self.by_words:
            return A.WEIGHT[raw], offsets, None
        w = A.words(raw, offsets)
        return w.hash, w.first, w


def owned_runs(spans: A.Spans, first: np.ndarray, rule: Rule) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor: text, first window, windows, anchor hash, content hash."""
    total = len(spans.sums) - 1
    fits = np.ones(total, bool)
    tails = np.minimum(np.diff(first), rule.length - 1)
    fits[A.ranges(first[1:] - tails, tails)] = False
    grams = spans.grams(rule.gram)
    grams = np.r_[grams, spans.hash(np.array([total - rule.gram]), np.array([total]))] if total >= rule.gram else grams
    starts, sizes, keys = [], [], []
    for a in range(0, total - rule.length + 1, BLOCK):
        b = min(a + BLOCK, total - rule.length + 1)
        g = grams[a : b + rule.length - rule.gram]
        least = A.sliding_min((g & ~PLACE) | np.arange(len(g), dtype=A.U), rule.length - rule.gram + 1)
        at = np.flatnonzero(fits[a:b])
        anchor = (least[at] & PLACE).astype(np.int64) + a
        new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)]) if len(at) else np.zeros(0, int)
        starts.append(at[new] + a)
        sizes.append(np.diff(np.r_[new, len(at)]))
        keys.append(A.mix(grams[anchor[new]]))  # anchors are small hashes; mixed again they spread evenly
    start, n, key = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((starts, np.int64), (sizes, np.int64), (keys, A.U)))
    content = A.mix(spans.hash(start, start + n + rule.length - 1) ^ A.mix(n.astype(A.U)))
    text = np.searchsorted(first, start, "right") - 1
    return {"text": text, "start": start - first[text], "n": n, "key": key, "content": content}


FOUND = "open int, home int, bucket int, doc binary, start binary, n binary, from_doc binary, from_start binary"
COLUMNS = {"doc": np.int64, "start": np.uint32, "n": np.uint16, "from_doc": np.int64, "from_start": np.uint32}


def found_schema(names: str = FOUND) -> pa.Schema:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in names.split(", ")])


def found_rows(columns: dict[str, np.ndarray], homes: int, is_open: int, bucket: int) -> list[pa.RecordBatch]:
    """Runs dealt out to the buckets of their documents."""
    typed = {k: columns[k].astype(t) for k, t in COLUMNS.items()}
    batch = A.scatter(fold_array(typed["doc"]) % homes, typed, {"open": is_open, "key": bucket})
    if batch is None:
        return []
    batch = batch.rename_columns([{"bucket": "home", "key": "bucket"}.get(c, c) for c in batch.schema.names])
    return pa.Table.from_batches([batch]).select(found_schema().names).cast(found_schema()).to_batches()


def found_columns(table: pa.Table) -> dict[str, np.ndarray]:
    """The runs of a bucket, from packed rows or from one row for each run."""
    if pa.types.is_binary(table.schema.field("doc").type):
        return {k: A.gather(table, k, t).astype(np.int64) for k, t in COLUMNS.items()}
    return {k: table[k].to_numpy().astype(np.int64) for k in COLUMNS}


def homes_of(docs: DataFrame, homes: int) -> tuple[DataFrame, str]:
    """The documents with a column for their bucket, and its name, which no other column has."""
    name = "home"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    return docs.withColumn(name, F.pmod(fold(F.col("doc_id").cast("long")), F.lit(homes)).cast("int")), name


def search(docs: DataFrame, rule: Rule) -> tuple[DataFrame, int]:
    """Runs that repeat as a whole (open 0), and the open ones to compare (open 1; 2 of hot anchors), in the buckets of their documents."""
    buckets = bucket_count(docs.sparkSession, 3)
    homes = bucket_count(docs.sparkSession, 1)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = A.flat(batch["text"])
            ids = batch["doc_id"].to_numpy()
            for i, j in A.slices(offsets, SMALL):
                values, first, _ = rule.elements(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                r = owned_runs(A.Spans(values), first, rule)
                target = ((r["key"] >> A.U(32)).astype(np.int64) * buckets) >> 32
                out = A.scatter(target, {"key": r["key"].astype(np.uint32), "content": r["content"], "doc": ids[i:j][r["text"]], "start": r["start"].astype(np.uint32), "n": r["n"].astype(rule.run_size)})
                if out is not None:
                    yield out

    def judge(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        key, content = A.gather(table, "key", np.uint32), A.gather(table, "content", np.uint64)
        doc, start, n = A.gather(table, "doc", np.int64), A.gather(table, "start", np.uint32), A.gather(table, "n", rule.run_size)
        order = np.lexsort((start, doc, content, key))
        key, content, doc, start, n = (x[order] for x in (key, content, doc, start, n))
        new_key = np.r_[True, key[1:] != key[:-1]]
        new = new_key | np.r_[True, content[1:] != content[:-1]]
        group = np.cumsum(new) - 1
        head = np.flatnonzero(new)
        contents = np.bincount(np.cumsum(new_key[head]) - 1)  # of each key
        is_open = np.repeat((contents > 1).astype(int) + (contents > max(rule.most, 1)), contents)[group]
        first_doc, first_start = doc[head][group], start[head][group]
        later = doc > first_doc
        if rule.same_document:
            later |= start > first_start
        again = np.r_[False, (doc[1:] == doc[:-1]) & (start[1:] == start[:-1])] & ~new
        columns = {"doc": doc, "start": start, "n": n, "from_doc": first_doc, "from_start": first_start}
        out = []
        for flag, rows in ((0, later & ~again), (1, (is_open == 1) & ~later & ~again), (2, (is_open == 2) & ~later & ~again)):
            out += found_rows({k: v[rows] for k, v in columns.items()}, homes, flag, bucket)
        return pa.Table.from_batches(out, found_schema())

    dealt = docs.select("doc_id", "text").mapInArrow(runs, "bucket int, key binary, content binary, doc binary, start binary, n binary")
    return cut(dealt.groupBy("bucket").applyInArrow(judge, FOUND)), homes


def positions(ids: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Row of each wanted id in ids."""
    order = np.argsort(ids, kind="stable")
    return order[np.searchsorted(ids[order], wanted)]


def first_whole(elements: np.ndarray, doc: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """For each of the windows that make up ``elements`` its first equal one (by document, then start)."""
    order = np.lexsort((start, doc))
    windows = np.ascontiguousarray(elements.reshape(-1, length)[order]).view(f"V{length * elements.itemsize}").ravel()
    _, head, same = np.unique(windows, return_index=True, return_inverse=True)
    first = np.empty(len(order), np.int64)
    first[order] = order[head[same]]
    return first


def compare(docs: DataFrame, found: DataFrame, homes: int, rule: Rule, windows: Callable[..., np.ndarray]) -> DataFrame:
    """The repeated windows of the open runs, as runs like those of search().

    ``windows`` gets the elements of all open runs of a bucket and says of each of their windows which one, the first, it repeats.
    """
    dtype = np.dtype(np.uint64 if rule.by_words else np.uint8)
    buckets = bucket_count(docs.sparkSession, 3)  # those from here on hold the windows of hot anchors

    def fetch(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = found_schema("bucket int, doc binary, start binary, n binary, elements binary")
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids = left["doc_id"].to_numpy()
        raw, offsets = A.flat(left["text"])
        r = found_columns(right)
        sizes = np.array([len(x) // 8 for x in right["doc"].to_pylist()])
        bucket, hot = np.repeat(right["bucket"].to_numpy(), sizes), np.repeat(right["open"].to_numpy() == 2, sizes)
        row = positions(ids, r["doc"])
        out = []
        for i, j in A.slices(offsets):
            at = np.flatnonzero((row >= i) & (row < j))
            if not len(at):
                continue
            values, first, _ = rule.elements(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            doc, start, windows_of, b, place = r["doc"][at], r["start"][at], r["n"][at], bucket[at], first[row[at] - i] + r["start"][at]
            if hot[at].any():
                cold, h = np.flatnonzero(~hot[at]), np.flatnonzero(hot[at])
                each = A.ranges(place[h], windows_of[h])
                own = ((A.Spans(values).hash(each, each + rule.length) >> A.U(32)).astype(np.int64) * buckets >> 32) + buckets
                doc, start = np.r_[doc[cold], np.repeat(doc[h], windows_of[h])], np.r_[start[cold], A.ranges(start[h], windows_of[h])]
                b, place, windows_of = np.r_[b[cold], own], np.r_[place[cold], each], np.r_[windows_of[cold], np.ones(len(each), np.int64)]
            order = np.argsort(b, kind="stable")
            doc, start, windows_of, b, place = (x[order] for x in (doc, start, windows_of, b, place))
            values = values if rule.by_words else raw[offsets[i] : offsets[j]]
            n = windows_of + rule.length - 1
            taken = values[A.ranges(place, n)].astype(dtype)
            ends = np.r_[0, np.cumsum(n)]
            cuts = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
            stops = np.r_[cuts[1:], len(b)]
            pick = lambda v: pa.array([v[x:y].tobytes() for x, y in zip(cuts.tolist(), stops.tolist())], pa.binary())
            text = pa.array([taken[ends[x] : ends[y]].tobytes() for x, y in zip(cuts.tolist(), stops.tolist())], pa.binary())
            out.append(pa.RecordBatch.from_arrays([pa.array(b[cuts].astype(np.int32)), pick(doc), pick(start.astype(np.uint32)), pick(windows_of.astype(np.uint16)), text], schema=schema))
        return pa.Table.from_batches(out, schema)

    opened = found.where("open > 0")
    placed, home = homes_of(docs.select("doc_id", "text"), homes)
    texts = placed.groupBy(home).cogroup(opened.groupBy("home")).applyInArrow(fetch, "bucket int, doc binary, start binary, n binary, elements binary")

    def judge(table: pa.Table) -> pa.Table:
        doc, start, n = A.gather(table, "doc", np.int64), A.gather(table, "start", np.uint32).astype(np.int64), A.gather(table, "n", np.uint16).astype(np.int64)
        elements = A.gather(table, "elements", dtype)
        begin = np.cumsum(n + rule.length - 1) - (n + rule.length - 1)
        at = A.ranges(begin, n)  # places of the windows
        run = np.repeat(np.arange(len(n)), n)
        window_doc, window_start = doc[run], start[run] + A.runs(n)
        hot = table["bucket"][0].as_py() >= buckets
        first = first_whole(elements, window_doc, window_start, rule.length) if hot else windows(elements, at, window_doc, window_start, rule.length)
        later = window_doc[first] < window_doc
        if rule.same_document:
            later |= (window_doc[first] == window_doc) & (window_start[first] < window_start)
        which = np.flatnonzero(later)
        source = first[which]
        d, s, fd, fs = window_doc[which], window_start[which], window_doc[source], window_start[source]
        # windows in a row that repeat a row of windows in one source
        new = np.flatnonzero(np.r_[True, (run[which][1:] != run[which][:-1]) | (s[1:] != s[:-1] + 1) | (fd[1:] != fd[:-1]) | (fs[1:] != fs[:-1] + 1)]) if len(which) else which
        columns = {"doc": d[new], "start": s[new], "n": np.diff(np.r_[new, len(which)]), "from_doc": fd[new], "from_start": fs[new]}
        return pa.Table.from_batches(found_rows(columns, homes, 0, -1), found_schema())

    return texts.groupBy("bucket").applyInArrow(judge, FOUND)


def covered(first: np.ndarray, row: np.ndarray, start: np.ndarray, n: np.ndarray, length: int) -> np.ndarray:
    """Which elements lie in the windows of the runs."""
    edge = np.zeros(int(first[-1]) + 1, np.int64)
    np.add.at(edge, first[row] + start, 1)
    np.add.at(edge, first[row] + start + n + length - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def apply(docs: DataFrame, found: DataFrame, homes: int, rule: Rule, finish: Callable[..., pa.Table], schema: str | StructType) -> DataFrame:
    """Give each bucket of documents its repeated runs; ``finish`` gets a slice of rows and its covered elements."""

    nothing = arrow_schema(docs.sparkSession, schema).empty_table()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows:
            r = found_columns(right)
            ids = left["doc_id"].to_numpy()
            raw, offsets = A.flat(left["text"])
            row = positions(ids, r["doc"])
            left = left.drop_columns([home])
            for i, j in A.slices(offsets):
                part, stops = raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                _, first, words = rule.elements(part, stops)
                at = np.flatnonzero((row >= i) & (row < j))
                removed = covered(first, row[at] - i, r["start"][at], r["n"][at], rule.length)
                out.append(finish(left.slice(i, j - i), part, stops, first, words, removed))
        return pa.concat_tables(out) if out else nothing

    placed, home = homes_of(docs, homes)
    return placed.groupBy(home).cogroup(found.groupBy("home")).applyInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str | StructType) -> pa.Schema:
    return to_arrow_schema(spark.createDataFrame([], schema).schema)
