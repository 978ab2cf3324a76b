"""Removal of word passages that occur earlier, by compaction of a De Bruijn graph.

Edges are the k-mers of words (k = ``length``), nodes the (k-1)-mers.  An edge is named by the place where it
occurs first, its source.  repeats.py collects the edges as runs around shared anchors and settles whole runs;
the edges of the open runs are matched by hash and verified word by word against the source.  Then:

1. Runs that go on in a document and in its source alike become spans.
2. Span ends cut the sources into pieces, which are paths without a branch; a running sum of span starts and ends over
   each source tells which pieces repeat, and how often.
3. Pieces that follow each other in some document are joined by arcs (Spark joins on places).  Where a piece has one
   successor and that piece one predecessor, the node between does not branch, and the two are
   compacted; components of these links, found by rounds of joins, are the compacted paths.
4. A span is removed if it, or the path it starts on, has ``min_words`` words.  The source coordinates of the span
   say which words these are.

Edge cases: null and empty texts give zero words and the hash of no bytes; texts shorter than a window lose nothing; of
rows that repeat an id the smallest text stands; rows with a null id are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from larkspur.llm import arrays as A, repeats
from larkspur.llm.components import components
from larkspur.llm.tables import cut, one_per_id, text_of

LENGTH = 20
SPANS = "home int, doc long, start long, n long, from_doc long, from_start long, before_doc long, before_stop long"


def rule_of(length: int) -> repeats.Rule:
    if length < 2:
        raise ValueError("windows of two words at least")
    return repeats.Rule(length, max(1, length // 3), True, True)


def first_windows(words: np.ndarray, at: np.ndarray, doc: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """For each edge its first equal one, by document, then place; equal hashes are compared word by word."""
    if not len(at):
        return at
    edge = A.Spans(words)
    edge = edge.hash(at, at + length)
    order = np.lexsort((start, doc, edge))
    heads = np.flatnonzero(np.r_[True, edge[order][1:] != edge[order][:-1]])
    first = np.empty(len(at), np.int64)
    first[order] = np.repeat(order[heads], np.diff(np.r_[heads, len(at)]))
    same = np.ones(len(at), bool)
    for k in range(length):
        same &= words[at + k] == words[at[first] + k]
    return np.where(same, first, np.arange(len(at)))


def spans_of(found: DataFrame) -> DataFrame:
    """Runs joined to spans; ``before`` is the end, in its source, of a span that ends where this one starts."""

    def run(table: pa.Table) -> pa.Table:
        home = table["home"][0].as_py()
        r = repeats.found_columns(table)
        order = np.lexsort((r["start"], r["doc"]))
        doc, start, n, fd, fs = (r[k][order] for k in ("doc", "start", "n", "from_doc", "from_start"))
        touches = (doc[1:] == doc[:-1]) & (start[1:] == start[:-1] + n[:-1])
        goes_on = touches & (fd[1:] == fd[:-1]) & (fs[1:] == fs[:-1] + n[:-1])
        head = np.flatnonzero(np.r_[True, ~goes_on])
        touch = np.r_[False, touches][head]
        stop = (fs + n)[np.maximum(head - 1, 0)]
        n = np.add.reduceat(n, head)
        return pa.table({
            "home": pa.array(np.full(len(head), home, np.int32)), "doc": doc[head], "start": start[head], "n": n, "from_doc": fd[head], "from_start": fs[head],
            "before_doc": pa.array(fd[np.maximum(head - 1, 0)], mask=~touch), "before_stop": pa.array(stop, mask=~touch),
        })

    return found.groupBy("home").applyInArrow(run, SPANS)


def pieces_of(spans: DataFrame) -> DataFrame:
    """Sources cut at all span ends: (doc, start, stop, copies), the repeated pieces only."""
    own, source = F.col("doc"), F.col("from_doc")
    events = F.array(
        F.struct(source.alias("doc"), F.col("from_start").alias("start"), F.lit(1).alias("change")),
        F.struct(source.alias("doc"), (F.col("from_start") + F.col("n")).alias("start"), F.lit(-1).alias("change")),
        F.struct(own.alias("doc"), F.col("start").alias("start"), F.lit(0).alias("change")),
        F.struct(own.alias("doc"), (F.col("start") + F.col("n")).alias("start"), F.lit(0).alias("change")),
    )
    # one row for each place of a document, summed before it is shuffled
    places = spans.select(F.inline(events)).groupBy("doc", "start").agg(F.sum("change").alias("change"))
    along = Window.partitionBy("doc").orderBy("start")
    return places.select("doc", "start", F.lead("start").over(along).alias("stop"), F.sum("change").over(along).alias("copies")).where("copies > 0")


def compact(spans: DataFrame, length: int = LENGTH) -> DataFrame:
    """Pieces with the path they belong to: (doc, start, stop, copies, path, path_words)."""
    pieces = cut(pieces_of(spans))
    tail = pieces.select(F.struct("doc", "start").alias("a"), F.col("doc").alias("a_doc"), F.col("stop").alias("a_stop"))
    head = pieces.select(F.struct("doc", "start").alias("b"), F.col("doc").alias("b_doc"), F.col("start").alias("b_start"))
    end = F.col("from_start") + F.col("n")
    along = spans.where("before_doc is not null").select("before_doc", "before_stop", "from_doc", "from_start")
    into = spans.select("doc", "start", "from_doc", "from_start")
    out = spans.select("from_doc", end, "doc", F.col("start") + F.col("n"))
    on = pieces.select("doc", "stop", "doc", "stop")
    arcs = along.union(into).union(out).union(on).toDF("a_doc", "a_stop", "b_doc", "b_start").distinct()
    arcs = cut(arcs.join(tail, ["a_doc", "a_stop"]).join(head, ["b_doc", "b_start"]).select("a", "b").where("a <> b"))
    # counted for each end before they are joined back, so that a node with many arcs stays small
    single_out = arcs.groupBy("a").agg(F.count("*").alias("c"), F.min("b").alias("b")).where("c = 1").select("a", "b")
    single_in = arcs.groupBy("b").agg(F.count("*").alias("c")).where("c = 1").select("b")
    labels = components(single_out.join(single_in, "b").select("a", "b"))
    named = pieces.join(labels.select(F.col("node.doc").alias("doc"), F.col("node.start").alias("start"), "root"), ["doc", "start"], "left")
    named = named.withColumn("path", F.coalesce("root", F.struct("doc", "start"))).drop("root")
    words = named.groupBy("path").agg((F.sum(F.col("stop") - F.col("start")) + length - 1).alias("path_words"))
    return named.join(words, "path")


def removable(docs: DataFrame, length: int, min_words: int) -> tuple[DataFrame, int]:
    """Spans to remove, each with its path: (home, doc, start, n, from_doc, from_start, path, path_words)."""
    rule = rule_of(length)
    found, homes = repeats.search(docs, rule)
    more = repeats.compare(docs, found, homes, rule, first_windows)
    spans = cut(spans_of(found.where("open = 0").union(more)))
    paths = compact(spans, length).select(F.col("doc").alias("from_doc"), F.col("start").alias("from_start"), "path", "path_words")
    long_enough = (F.col("path_words") >= min_words) | (F.col("n") + (length - 1) >= min_words)
    return spans.join(paths, ["from_doc", "from_start"]).where(long_enough), homes


def _kept(raw: np.ndarray, w: A.Words, removed: np.ndarray) -> list[bytes]:
    """The words that stay of each text, joined by a space."""
    keep = ~removed
    start, stop = w.start[keep], w.stop[keep]
    padded = np.r_[raw, np.uint8(32)]
    size = stop - start + 1
    out = padded[A.ranges(start, size)]
    ends = np.cumsum(size)
    out[ends - 1] = 32
    out = out.tobytes()
    last = np.r_[0, np.cumsum(keep)][w.first]  # kept words before each text
    cuts = np.r_[0, ends][last]
    return [out[a : max(a, b - 1)] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def remove_passages(docs: DataFrame, length: int = LENGTH, min_words: int | None = None) -> DataFrame:
    """Word counts and the hash of the words that stay, of every document."""
    docs = one_per_id(text_of(docs))
    spans, homes = removable(docs, length, min_words or length)

    def finish(rows: pa.Table, raw: np.ndarray, offsets: np.ndarray, first: np.ndarray, w: A.Words, removed: np.ndarray) -> pa.Table:
        gone = np.diff(np.r_[0, np.cumsum(removed)][first])
        hashes = [hashlib.sha256(x).hexdigest() for x in _kept(raw, w, removed)]
        return pa.table({"doc_id": rows["doc_id"], "n_words": np.diff(first), "n_removed": gone, "kept_sha256": hashes})

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return repeats.apply(docs, spans, homes, rule_of(length), finish, schema)


def without_passages(docs: DataFrame, length: int = LENGTH, min_words: int | None = None) -> DataFrame:
    """The documents with their remaining words as text, and ``n_chars`` (if there) counted anew; other columns as they are."""
    docs = docs.where("doc_id is not null")
    spans, homes = removable(one_per_id(text_of(docs)), length, min_words or length)
    schema = docs.schema

    def finish(rows: pa.Table, raw: np.ndarray, offsets: np.ndarray, first: np.ndarray, w: A.Words, removed: np.ndarray) -> pa.Table:
        touched = np.diff(np.r_[0, np.cumsum(removed)][first]) > 0
        texts = [k.decode() if t else old for t, k, old in zip(touched.tolist(), _kept(raw, w, removed), rows["text"].to_pylist(), strict=True)]
        rows = rows.set_column(rows.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))
        if "n_chars" in rows.schema.names:
            sizes = pa.array([None if x is None else len(x) for x in texts], pa.int64())
            rows = rows.set_column(rows.schema.get_field_index("n_chars"), "n_chars", sizes.cast(rows.schema.field("n_chars").type))
        return rows

    return repeats.apply(one_per_id(docs), spans, homes, rule_of(length), finish, schema)
