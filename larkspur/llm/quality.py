"""Quality rules: gradient-boosted trees over document statistics.

The trees are fitted on a bounded sample of labelled documents (``MAX_LABELLED``
rows, those with the smallest hash of their id), with monotonic constraints on
chosen features, and flattened into node arrays.  Scoring walks all documents of
a batch through one tree level at a time.  Fixed rules (``base_failed``) stand
beside the trees; a document is kept if neither rejects it.

Edge cases: a null text counts as empty, has no words and fails the fixed rules;
rows with a null id are left out; of rows that repeat an id ``keep`` takes the
one with the smallest text, ``judge`` judges each; labels that are null or unknown are not used; without
any usable label (or with one class only) the trees reject nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from larkspur.llm import arrays as A
from larkspur.llm.tables import one_per_id, text_of

MAX_LABELLED = 20_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
CLASSES = {
    "digits": np.isin(np.arange(256), list(b"0123456789")),
    "upper": np.isin(np.arange(256), list(range(65, 91))),
    "stops": np.isin(np.arange(256), list(b".!?")),
    "punct": np.isin(np.arange(256), list(b",;:()[]{}\"'`/\\@=_-+~^")),
}
#: Features of the trees; +1: a larger value never lowers the score, -1: never raises it.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_rate": -1, "dup_line_rate": -1, "repeat_rate": -1,
    "distinct_rate": 0, "digits_rate": 0, "upper_rate": 0, "stops_rate": 0, "punct_rate": 0, "wide_rate": 0, "line_words": 0,
}


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _sorted_groups(text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by text and value, and where a new pair begins in it."""
    key = A.mix(value ^ A.mix(text.astype(A.U) + A.U(1)))
    order = np.argsort(key)
    key = key[order]
    return order, np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)


def statistics(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of each text of a slice."""
    n = len(offsets) - 1
    w = A.words(raw, offsets)
    text = w.text
    out = {"n_words": w.counts.astype(np.int64)}
    lead = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=lead[1:])
    out["word_chars"] = np.bincount(text, lead[w.stop] - lead[w.start], n).astype(np.int64)
    out["n_symbols"] = _per_text(SYMBOLS[raw], offsets)
    for name, flags in CLASSES.items():
        out[name] = _per_text(flags[raw], offsets)
    out["wide"] = _per_text((raw & 0xC0) == 0xC0, offsets)

    # lines: between line feeds; they count if a word begins in them
    feeds = np.flatnonzero(raw == 10)
    begins = np.unique(np.r_[offsets[:-1], feeds + 1])
    begins = begins[begins < len(raw)]
    stops = np.r_[begins[1:], len(raw)]
    stops = stops - ((stops > begins) & (raw[stops - 1] == 10)) if len(begins) else stops
    has = np.searchsorted(w.start, stops) > np.searchsorted(w.start, begins)
    begins, stops = begins[has], stops[has]
    owner = np.searchsorted(offsets, begins, "right") - 1
    out["n_lines"] = np.bincount(owner, minlength=n)
    order, new = _sorted_groups(owner, A.Spans(A.WEIGHT[raw]).hash(begins, stops) + (stops - begins).astype(A.U))
    out["n_dup_lines"] = out["n_lines"] - np.bincount(owner[order[new]], minlength=n)

    order, new = _sorted_groups(text, w.hash)
    out["n_distinct"] = np.bincount(text[order[new]], minlength=n)

    # words in windows of three that occur at least twice in the text
    covered = np.zeros(len(text), bool)
    if len(text) >= 3:
        at = np.flatnonzero(text[2:] == text[:-2])
        three = A.Spans(w.hash).grams(3)[at]
        order, new = _sorted_groups(text[at], three)
        single = new & np.r_[new[1:], True] if len(new) else new
        at = at[order[~single]]
        for k in range(3):
            covered[at + k] = True
    out["n_repeat_words"] = np.bincount(text[covered], minlength=n)
    out["bytes"] = np.diff(offsets)
    return out


def feature_matrix(s: dict[str, np.ndarray]) -> np.ndarray:
    words, size, lines = np.maximum(s["n_words"], 1), np.maximum(s["bytes"], 1), np.maximum(s["n_lines"], 1)
    columns = [
        np.log1p(s["n_words"]), s["word_chars"] / words, s["n_symbols"] / words, s["n_dup_lines"] / lines, s["n_repeat_words"] / words,
        s["n_distinct"] / words, s["digits"] / size, s["upper"] / size, s["stops"] / words, s["punct"] / size, s["wide"] / size, np.log1p(words / lines),
    ]
    return np.column_stack(columns).astype(float)


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


@dataclass
class Trees:
    """All trees in one set of node arrays; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float
    cut: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality."""
        rows, total = np.arange(len(x)), np.full(len(x), self.bias)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))

    def keeps(self, x: np.ndarray) -> np.ndarray:
        return self.score(x) >= self.cut


def fit_trees(x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 64, least: int = 20, ridge: float = 1.0) -> Trees:
    """Boosted trees for a 0/1 label with logistic loss, split at quantiles.

    A constrained feature may only be split if the child values keep its sign; the
    middle of the two values then bounds everything below.
    """
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    codes = np.column_stack([np.searchsorted(e, c) for e, c in zip(edges, x.T, strict=True)])  # code <= k: value <= edge k
    mean = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    bias = float(np.log(mean / (1 - mean)))
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    margin = np.full(len(y), bias)
    roots = []

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        me = len(nodes)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        own = float(np.clip(total_g / (total_h + ridge), low, high))
        nodes.append([0, np.inf, me, me, rate * own])
        best, pick = 1e-6, None
        if level < depth and len(rows) >= 2 * least:
            for f, sign in enumerate(signs):
                width = len(edges[f]) + 1
                if width < 2:
                    continue
                code = codes[rows, f]
                lg, lh, ln = (np.cumsum(np.bincount(code, v, width))[:-1] for v in (g[rows], h[rows], None))
                lv, rv = np.clip(lg / (lh + ridge), low, high), np.clip((total_g - lg) / (total_h - lh + ridge), low, high)
                gain = 2 * (lv * lg + rv * (total_g - lg) - own * total_g) - (lv**2 * (lh + ridge) + rv**2 * (total_h - lh + ridge) - own**2 * (total_h + ridge))
                gain[(ln < least) | (len(rows) - ln < least) | (sign * (rv - lv) < 0)] = -1
                k = int(np.argmax(gain))
                if gain[k] > best:
                    best, pick = gain[k], (f, k, sign, float(lv[k] + rv[k]) / 2)
        if pick:
            f, k, sign, middle = pick
            go = codes[rows, f] <= k
            bounds = [(low, high)] * 2 if not sign else [(low, middle), (middle, high)][:: sign]
            children = [grow(part, g, h, level + 1, *b) for part, b in zip((rows[go], rows[~go]), bounds, strict=True)]
            nodes[me] = [f, edges[f][k], *children, 0.0]
        return me

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        root = grow(np.arange(len(y)), y - p, p * (1 - p), 0, -np.inf, np.inf)
        roots.append(root)
        table = np.array(nodes[root:])
        node = np.zeros(len(y), int)
        for _ in range(depth):
            node = np.where(x[np.arange(len(y)), table[node, 0].astype(int)] <= table[node, 1], table[node, 2], table[node, 3]).astype(int) - root
        margin += table[node, 4]
    flat = np.array(nodes)
    return Trees(flat[:, 0].astype(int), flat[:, 1], flat[:, 2].astype(int), flat[:, 3].astype(int), flat[:, 4], np.array(roots), depth, bias, 0.5)


def fit(docs: DataFrame, labels: DataFrame, most_lost: float = 0.001, max_labelled: int = MAX_LABELLED) -> Trees | None:
    """Trees from a bounded sample of labelled documents.

    The cut is the lower of one half and the score that ``most_lost`` of the good
    documents in the sample stay below, so that clean documents pass.
    """
    sample = (
        labels.where("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    )
    chosen = {r.doc_id: r.label for r in sample.collect()}  # at most max_labelled rows
    if len(set(chosen.values())) < 2:
        return None
    ids = docs.sparkSession.createDataFrame([(i,) for i in chosen], "doc_id long")
    wanted = text_of(docs).join(F.broadcast(ids), "doc_id", "left_semi")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = A.flat(batch["text"])
            for i, j in A.slices(offsets):
                s = statistics(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                x = feature_matrix(s)[~base_failed(s)]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(i, j - i).filter(pa.array(~base_failed(s))), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "x"])

    rows = sorted((r.doc_id, *r.x) for r in wanted.mapInArrow(features, "doc_id long, x array<double>").collect())
    rows = [r for k, r in enumerate(rows) if not k or rows[k - 1][0] != r[0]]
    y = np.array([chosen[r[0]] for r in rows])
    if len(set(y.tolist())) < 2:
        return None
    x = np.array([r[1:] for r in rows])
    trees = fit_trees(x, y, list(FEATURES.values()))
    trees.cut = float(min(0.5, np.quantile(trees.score(x[y == 1]), most_lost)))
    return trees


def _verdict(trees: Trees | None, s: dict[str, np.ndarray]) -> np.ndarray:
    kept = ~base_failed(s)
    return kept & trees.keeps(feature_matrix(s)) if trees and len(kept) else kept


def judge(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """Statistics and verdict of every document; one map over the texts, no shuffle."""
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = A.flat(batch["text"])
            for i, j in A.slices(offsets):
                s = statistics(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                score = trees.score(feature_matrix(s)) if trees else np.ones(j - i)
                data = [batch["doc_id"].slice(i, j - i), *(pa.array(s[c].astype(np.int64)) for c in columns), pa.array(base_failed(s)), pa.array(_verdict(trees, s)), pa.array(score)]
                yield pa.RecordBatch.from_arrays(data, ["doc_id", *columns, "base_failed", "kept", "quality_score"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in columns) + ", base_failed boolean, kept boolean, quality_score double"
    return text_of(docs).mapInArrow(run, schema)


def keep(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """The documents that pass, with all their columns; one row of each id."""
    docs = one_per_id(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = A.flat(batch["text"])
            passed = [_verdict(trees, statistics(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])) for i, j in A.slices(offsets)]
            if passed:
                yield batch.filter(pc.cast(pa.array(np.concatenate(passed)), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
