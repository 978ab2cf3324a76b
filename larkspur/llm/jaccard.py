"""Documents linked by the Jaccard similarity of their word n-grams: a size-aware heavy-light join.

1. Equal texts are collapsed in each task, then dealt into chunks by the hash of the text.
2. Frequencies are counted by hash range for the shingles of the lower ``COUNTED`` part of
   the hash space.  One global order follows: counted shingles by frequency, then the others.
   A set with a link must share one of its first n - ceil(0.8 n) + 1 shingles, so a set whose first
   shingles all occur once has no link and is done.
3. The sets that remain are joined.  *Light* pairs (both sets up to a boundary): every set
   lists its subsets of each size k that a partner's size asks for; sets that share a subset of k shingles and
   have sizes n + m <= 9k/4 are linked, and within a list it is enough to link all of them to the
   smallest set.  *Heavy* pairs: inverted lists of the first shingles are scanned.  Each set is compared
   with the smallest document most often listed with it; the sets that link form classes; then
   pairs from different classes that share a list are compared, if the parities of their elements do not rule them out.  Pairs inside
   a class are never formed.
   The boundary is the size at which the cost of subsets passes that of lists.
4. Links become components by joins.

Edge cases: a null or empty text, or one without words, has no shingles and no links; fewer than n
words form one shingle; repeated rows of one id count as one document (its smallest component stands);
rows with a null id are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larkspur.llm import arrays as A
from larkspur.llm.components import components
from larkspur.llm.tables import bucket_count, cut, one_per_id, text_of

N = 5
COUNTED = 0.4
PARITY_WORDS = 16
ROUNDS = 1  # of comparisons with one other set each, before all pairs between classes
LARGEST_LIGHT = 24  # subsets of larger sets are never cheaper than lists


def shingles(raw: np.ndarray, offsets: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted: hashes, and offsets by text."""
    w = A.words(A.LOWER[raw], offsets)
    text, many = w.text, w.counts
    grams = A.Spans(w.hash).grams(n)
    inside = text[n - 1 :] == text[: len(text) - n + 1] if len(text) >= n else np.zeros(0, bool)
    owner, value = text[: len(grams)][inside], grams[inside]
    short = np.flatnonzero((many > 0) & (many < n))
    if len(short):
        whole = A.Spans(w.hash).hash(w.first[short], w.first[short + 1]) + many[short].astype(A.U)
        owner, value = np.r_[owner, short], np.r_[value, A.mix(whole)]
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.r_[True, (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])] if len(owner) else np.zeros(0, bool)
    owner, value = owner[new], value[new]
    return value, np.searchsorted(owner, np.arange(len(offsets)))


def needed(n: int, m: int) -> int:
    """Smallest overlap of sets of n and m elements with 100 * common >= 80 * union."""
    return -(-4 * (n + m) // 9)


def first_few(n: np.ndarray) -> np.ndarray:
    """How many of the first elements must hold a common one: n - ceil(0.8 n) + 1."""
    return n - (4 * n + 4) // 5 + 1


def subset_sizes(n: int) -> list[int]:
    return sorted({needed(n, m) for m in range((4 * n + 4) // 5, 5 * n // 4 + 1)})


def subset_count(n: int) -> int:
    return sum(math.comb(n, k) for k in subset_sizes(n))


def boundary(sizes: list[tuple[int, int, int]], compare: int = 20) -> int:
    """Largest light size, from (size, sets, listed shingles): sums of both costs, smallest total."""
    light = list(range(max((n for n, _, _ in sizes if n <= LARGEST_LIGHT), default=0) + 1))
    cost = lambda x: sum(sets * subset_count(n) if n <= x else listed + compare * sets for n, sets, listed in sizes)
    return min(light, key=cost, default=0)


def _sets(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = A.flat(table["text"])
    values, stops, done = [np.zeros(0, A.U)], [np.zeros(1, np.int64)], 0
    for i, j in A.slices(offsets):
        v, o = shingles(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        values.append(v)
        stops.append(o[1:] + done)
        done += len(v)
    return np.concatenate(values), np.concatenate(stops)


def _distinct(table: pa.Table) -> pa.Table:
    """One row for each text of a chunk, its ids joined; smallest id first in each."""
    table = table.sort_by("digest")
    digest = table["digest"].to_numpy(zero_copy_only=False)
    new = np.flatnonzero(np.r_[True, digest[1:] != digest[:-1]]) if len(digest) else np.zeros(0, int)
    ids = table["ids"].to_pylist()
    joined = [np.unique(np.frombuffer(b"".join(ids[a:b]), np.int64)).tobytes() for a, b in zip(new.tolist(), [*new[1:].tolist(), len(ids)])]
    return pa.table({"text": table["text"].take(pa.array(new)), "ids": pa.array(joined, pa.binary())})


ASKED = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("value", pa.binary()), ("more", pa.binary())])


def candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, rep, n_shingles) of all documents, and the sets that may have links:
    (rep, n, shingles sorted as bytes, first: the shingles of the prefix that others have, places: their places in the order, listed: their number)."""
    spark = docs.sparkSession
    buckets = bucket_count(spark, 2)
    counted = int(COUNTED * 2**32)

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes, list[int]] = {}
            texts = batch["text"]
            raw, offsets = A.flat(texts)
            view = memoryview(raw.tobytes())
            for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                seen.setdefault(hashlib.md5(view[a:b]).digest(), []).append(k)
            ids = batch["doc_id"].to_numpy()
            where = pa.array([rows[0] for rows in seen.values()])
            chunk = [int.from_bytes(d[:6], "big") % buckets for d in seen]
            yield pa.RecordBatch.from_arrays([pa.array(chunk, pa.int32()), pa.array(list(seen), pa.binary()), texts.take(where), pa.array([ids[r].tobytes() for r in seen.values()], pa.binary())], ["chunk", "digest", "text", "ids"])

    dealt = text_of(docs).mapInArrow(collapse, "chunk int, digest binary, text string, ids binary")

    def requests(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The counted shingles: bucket and key in it."""
        high, low = (value >> A.U(32)).astype(np.int64), value.astype(np.uint32)
        return np.where(high < counted, high * buckets // counted, -1), low

    def ask(table: pa.Table) -> pa.Table:
        chunk = table["chunk"][0].as_py()
        table = _distinct(table)
        value, stops = _sets(table)
        ids = [np.frombuffer(x, np.int64) for x in table["ids"].to_pylist()]
        sizes = np.array([len(x) for x in ids])
        n = np.diff(stops)
        members = np.column_stack([np.concatenate(ids), np.repeat([x[0] for x in ids], sizes), np.repeat(n, sizes)]).astype(np.int64)
        members[members[:, 2] == 0, 1] = members[members[:, 2] == 0, 0]  # empty sets are linked with nothing
        out = [pa.RecordBatch.from_pylist([{"bucket": -1, "chunk": chunk, "value": members.tobytes(), "more": b""}], ASKED)]
        unique, times = np.unique(value, return_counts=True)
        bucket, low = requests(unique)
        use = bucket >= 0
        batch = A.scatter(bucket[use], {"value": low[use], "more": np.minimum(times[use], 255).astype(np.uint8)}, {"chunk": chunk})
        if batch is not None:
            out += pa.Table.from_batches([batch]).select(ASKED.names).cast(ASKED).to_batches()
        return pa.Table.from_batches(out, ASKED)

    asked = cut(dealt.groupBy("chunk").applyInArrow(ask, "bucket int, chunk int, value binary, more binary"))

    def count(table: pa.Table) -> pa.Table:
        """For each chunk the frequencies of its shingles of this range, up to 255, in the order asked."""
        table = table.sort_by("chunk")
        values, times = A.gather(table, "value", np.uint32), A.gather(table, "more", np.uint8)
        unique, at = np.unique(values, return_inverse=True)
        total = np.minimum(np.bincount(at, times, len(unique)), 255).astype(np.uint8)[at]
        stops = np.cumsum([len(x) // 4 for x in table["value"].to_pylist()])
        answers = [total[a:b].tobytes() for a, b in zip([0, *stops[:-1].tolist()], stops.tolist())]
        return pa.table([table["chunk"].cast(pa.int32()), table["bucket"].cast(pa.int32()), pa.chunked_array([pa.array(answers, pa.binary())])], ["chunk", "bucket", "more"])

    counts = asked.where("bucket >= 0").groupBy("bucket").applyInArrow(count, "chunk int, bucket int, more binary")

    def choose(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("rep", pa.int64()), ("n", pa.int32()), ("shingles", pa.binary()), ("first", pa.binary()), ("places", pa.binary()), ("listed", pa.int32())])
        if not left.num_rows:
            return schema.empty_table()
        table = _distinct(left)
        value, stops = _sets(table)
        unique, at = np.unique(value, return_inverse=True)
        bucket, _ = requests(unique)
        frequency = np.full(len(unique), 256, np.int64)
        frequency[bucket >= 0] = A.gather(right.sort_by("bucket"), "more", np.uint8)
        rank = frequency[at]
        owner = np.repeat(np.arange(len(stops) - 1), np.diff(stops))
        order = np.lexsort((value, rank, owner))
        n = np.diff(stops)
        reach = np.where(n > 0, first_few(n), 0)
        chosen, place = order[A.ranges(stops[:-1], reach)], A.runs(reach).astype(np.int32)
        place, chosen = place[rank[chosen] > 1], chosen[rank[chosen] > 1]
        listed = np.bincount(owner[chosen], minlength=len(n))
        cuts = np.r_[0, np.cumsum(listed)]
        rows = np.flatnonzero(listed)
        ids = table["ids"].to_pylist()
        return pa.table([
            pa.array([int(np.frombuffer(ids[r][:8], np.int64)[0]) for r in rows], pa.int64()), pa.array(n[rows].astype(np.int32)),
            pa.array([value[stops[r] : stops[r + 1]].tobytes() for r in rows], pa.binary()),
            pa.array([value[chosen[cuts[r] : cuts[r + 1]]].tobytes() for r in rows], pa.binary()),
            pa.array([place[cuts[r] : cuts[r + 1]].tobytes() for r in rows], pa.binary()), pa.array(listed[rows].astype(np.int32)),
        ], schema)

    sets = cut(dealt.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(choose, "rep long, n int, shingles binary, first binary, places binary, listed int"))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch["value"].to_pylist():
                table = np.frombuffer(blob, np.int64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(table[:, k])) for k in range(3)], ["doc_id", "rep", "n_shingles"])

    return asked.where("bucket < 0").mapInArrow(members, "doc_id long, rep long, n_shingles long"), sets


def light_links(sets: DataFrame, largest: int) -> DataFrame:
    """Links between sets of up to ``largest`` shingles, by common subsets: (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rep, n, blob in zip(batch["rep"].to_pylist(), batch["n"].to_pylist(), batch["shingles"].to_pylist()):
                value = np.frombuffer(blob, np.uint64)
                for k in subset_sizes(n):
                    at = np.array(list(combinations(range(n), k)))
                    # elements are sorted, so equal subsets are equal rows; two sums name a row
                    low, high = A.mix(value)[at].sum(axis=1), A.mix(value ^ A.U(A.BASE))[at].sum(axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(low.view(np.int64)), pa.array(high.view(np.int64)), pa.array(np.full(len(at), n, np.int32)), pa.array(np.full(len(at), rep))], ["k", "low", "high", "n", "rep"])

    subsets = sets.where(F.col("n") <= largest).select("rep", "n", "shingles").mapInArrow(run, "k int, low long, high long, n int, rep long")
    smallest = subsets.groupBy("k", "low", "high").agg(F.min(F.struct("n", "rep")).alias("s"), F.count("*").alias("c")).where("c > 1").drop("c")
    pairs = subsets.join(smallest, ["k", "low", "high"]).where("rep <> s.rep and 4 * (n + s.n) <= 9 * k")
    return pairs.select(F.col("rep").alias("a"), F.col("s.rep").alias("b")).distinct()


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar enough, by comparing the whole sets."""
    bare = sets.select("rep", "shingles")
    both = pairs.join(bare.toDF("a", "x"), "a").join(bare.toDF("b", "y"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep.append(100 * common >= 80 * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch["a"].filter(pa.array(keep, pa.bool_())), batch["b"].filter(pa.array(keep, pa.bool_()))], ["a", "b"])

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def can_reach(n: str, place: str, m: str, other_place: str) -> str:
    """Sizes that fit, and enough elements left at the first common one on both sides (SQL)."""
    need = f"4 * ({n} + {m})"
    return f"5 * {n} >= 4 * {m} and 5 * {m} >= 4 * {n} and 9 * ({n} - {place}) >= {need} and 9 * ({m} - {other_place}) >= {need}"


def heavy_links(sets: DataFrame, above: int, rounds: int = ROUNDS) -> DataFrame:
    """Links between sets of which one at least has more than ``above`` shingles: (a, b).

    A linked pair shares a list in which both have enough elements left (that of its first common element), so only
    these entries count.  A round compares each set with one smaller document of another class; what links joins
    a class.  Of the pairs that are left between classes, parity words rule out those that differ too much
    where the lists are joined; the others are compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = A.flat(batch["first"])
            places, _ = A.flat(batch["places"])
            each = np.diff(offsets) // 8
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(raw.tobytes(), np.int64)), pa.array(np.repeat(batch["rep"].to_numpy(), each)), pa.array(np.repeat(batch["n"].to_numpy(), each)), pa.array(np.frombuffer(places.tobytes(), np.int32))], ["item", "rep", "n", "place"])

    # a partner of a heavy set has at least 0.8 times its size
    entries = sets.where(F.col("n") * 5 >= 4 * (above + 1)).select("rep", "n", "first", "places").mapInArrow(run, "item long, rep long, n int, place int")
    lists = cut(entries.withColumn("class", F.col("rep")))
    tried = None
    links = None
    for _ in range(rounds):
        # for each list the smallest member of the smallest class, and of the next class up
        low = lists.groupBy("item").agg(F.min(F.struct("class", "rep", "n", "place")).alias("low"), F.max("class").alias("high")).where("low.class < high").select("item", "low")
        open_lists = lists.join(low, "item").where("class <> low.class and " + can_reach("n", "place", "low.n", "low.place"))
        votes = open_lists.groupBy("rep", F.col("low.rep").alias("b"), F.col("low.class").alias("other"), "class").agg(F.count("*").alias("c"))
        if tried is not None:
            votes = votes.join(tried, ["rep", "b"], "left_anti")
        best = cut(votes.groupBy("rep").agg(F.max_by("b", F.struct("c", -F.col("b"))).alias("b")))
        if best.isEmpty():
            break
        tried = best if tried is None else tried.union(best)
        found = cut(_linked(best.select(F.col("rep").alias("a"), "b"), sets))
        links = found if links is None else links.union(found)
        labels = components(links).toDF("rep", "root")
        lists = cut(entries_of(lists, labels))
    mixed = lists.groupBy("item").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select("item")
    rest = lists.join(mixed, "item", "left_semi")
    rest = cut(rest.join(parities(sets.join(rest.select("rep"), "rep", "left_semi")), "rep"))
    left, right = (rest.select("item", F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("class").alias(f"c{x}"), F.col("place").alias(f"p{x}"), *(F.col(f"w{k}").alias(f"{x}{k}") for k in range(PARITY_WORDS))) for x in "ab")
    differ = " + ".join(f"bit_count(a{k} ^ b{k})" for k in range(PARITY_WORDS))
    pairs = left.join(right, "item").where(f"ca < cb and {can_reach('na', 'pa', 'nb', 'pb')} and 9 * ({differ}) <= na + nb").select("a", "b").distinct()
    last = _linked(pairs, sets)
    return last if links is None else links.union(last)


def parities(sets: DataFrame) -> DataFrame:
    """For each set, of how many of its elements fall on each of 64 * PARITY_WORDS bits, the parity: (rep, w0, w1, ...).

    Common elements cancel in the exclusive or of two sets, so its bits are at most the elements that only one of them
    has.  Sets link if these are at most a ninth of n + m.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.zeros((len(batch), 64 * PARITY_WORDS), np.uint8)
            for k, blob in enumerate(batch["shingles"]):
                place = (A.mix(np.frombuffer(blob.as_buffer(), np.uint64)) % A.U(64 * PARITY_WORDS)).astype(np.int64)
                bits[k] = np.bincount(place, minlength=64 * PARITY_WORDS) & 1
            words = np.packbits(bits, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["rep"], *(pa.array(np.ascontiguousarray(words[:, k])) for k in range(PARITY_WORDS))], ["rep", *(f"w{k}" for k in range(PARITY_WORDS))])

    return sets.select("rep", "shingles").mapInArrow(run, "rep long, " + ", ".join(f"w{k} long" for k in range(PARITY_WORDS)))


def entries_of(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """The entries with their classes anew."""
    return lists.drop("class").join(labels, "rep", "left").withColumn("class", F.coalesce("root", "rep")).select("item", "rep", "n", "place", "class")


def join_documents(docs: DataFrame) -> DataFrame:
    """Shingle count and component of every document."""
    members, sets = candidates(docs)
    sizes = sets.where(F.col("n") <= LARGEST_LIGHT).groupBy("n").agg(F.count("*").alias("sets"), F.sum("listed").alias("listed"))
    largest = boundary([(r.n, r.sets, r.listed) for r in sizes.collect()])  # at most LARGEST_LIGHT rows
    links = light_links(sets, largest).union(heavy_links(sets, largest))
    labels = components(links)
    placed = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component_id", F.coalesce("root", "rep"))
    return placed.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"), F.min("component_id").alias("component_id"))


def representatives(docs: DataFrame) -> DataFrame:
    """The documents that stay: the smallest id of each component, with all columns.

    Of rows that repeat an id the one with the smallest text stands; rows without an id are left out.
    """
    docs = one_per_id(docs)
    first = join_documents(docs).where("doc_id = component_id").select("doc_id")
    return docs.alias("d").join(first.alias("f"), F.col("d.doc_id") == F.col("f.doc_id"), "left_semi")
