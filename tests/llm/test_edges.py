"""Null, empty and repeated rows, long windows, and workers that do not have the package."""

import hashlib
import json
import os
import random
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from larkspur.llm import arrays as A, debruijn, jaccard, packing, pieces, quality, suffix
from larkspur.llm.tables import one_per_id

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
NOTHING = hashlib.sha256(b"").hexdigest()


@pytest.fixture(scope="module")
def fresh(tmp_path_factory):
    """Results of all operators and stages by name and table, made by workers without the repository."""
    folder = tmp_path_factory.mktemp("elsewhere")
    inherited = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fresh_workers.py")
    done = subprocess.run([sys.executable, script, REPO], cwd=folder, env=inherited, capture_output=True, text=True, timeout=1200)
    assert done.returncode == 0, done.stderr[-3000:]
    out = {}
    for line in done.stdout.splitlines():
        operator, table, rows = line.split(" ", 2)
        out[operator, table] = sorted(json.loads(rows), key=lambda r: r["doc_id"])
    return out


@pytest.mark.parametrize("table, ids", [("nulls", range(1, 7)), ("mixed", [k for k in range(1, 13) if k % 3])])
def test_null_and_empty_texts(fresh, table, ids):
    """A table of nulls, and the null (1, 4, ...) and empty (2, 5, ...) texts among others."""
    fresh, ids = {k: [r for r in rows if r["doc_id"] in ids] for k, rows in fresh.items()}, list(ids)
    expected = {
        "op1": {"n_bytes": 0, "n_removed": 0, "n_spans": 0, "kept_sha256": NOTHING},
        "op3": {"n_tokens": 0, "n_bytes": 0, "n_chunks": 1},
        "op4": {"n_words": 0, "n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0},
        "op5": {"n_words": 0, "n_removed": 0, "kept_sha256": NOTHING},
        "op6": {"n_words": 0, "word_chars": 0, "n_symbols": 0, "n_dup_lines": 0, "n_repeat_words": 0, "base_failed": True, "kept": False},
        "op7": {"start": 0, "length": 1, "doc_tokens": 1, "ids_crc32": zlib.crc32(np.array([1], "<u4").tobytes())},
        "op8": {"n_tokens": 1},
        "op9": {"n_shingles": 0},
        "op10": {"n_tokens": 1, "ids_crc32": zlib.crc32(np.array([2], "<u4").tobytes())},
    }
    for operator, columns in expected.items():
        rows = fresh[operator, table]
        assert [r["doc_id"] for r in rows] == ids, operator
        assert all(r[c] == v for r in rows for c, v in columns.items()), operator
    assert [r["component_id"] for r in fresh["op9", table]] == ids
    assert table == "mixed" or [r["start"] for r in fresh["op10", table]] == list(range(6))
    assert fresh["quality", table] == []
    for stage in ("n-gram_Jaccard_join", "substring_dedup"):
        assert [(r["doc_id"], r["text"], r["lang"]) for r in fresh[stage, table]] == [(i, "" if table == "mixed" and i % 3 == 2 else None, "en") for i in ids]
    assert [(r["doc_id"], r["length"]) for r in fresh["packing", table]] == [(i, 1) for i in ids]


def test_texts_among_nulls(fresh):
    for k in (1, 3, 4, 5, 6, 7, 8, 9, 10):
        assert [r["doc_id"] for r in fresh[f"op{k}", "mixed"]] == list(range(1, 13))
    assert [r["doc_id"] for r in fresh["quality", "mixed"]] == [3, 6, 9, 12]
    assert [r["n_words"] for r in fresh["op5", "mixed"]] == [0, 0, 60] * 4


def test_no_powers_at_first(monkeypatch):
    monkeypatch.setattr(A, "POWERS", {})
    assert len(A.powers(A.BASE, 0)) == 0 and A.powers(A.INVERSE, 2).tolist() == [1, A.INVERSE]


def same_as(rows, length, same_document):
    """Removed counts by brute force for (id, sequence) in order."""
    seen, out = {}, {}
    for i, sequence in rows:
        gone = [False] * len(sequence)
        for k in range(len(sequence) - length + 1):
            window = sequence[k : k + length]
            if window in seen and (same_document or seen[window] != i):
                gone[k : k + length] = [True] * length
            seen.setdefault(window, i)
        out[i] = sum(gone)
    return out


@pytest.mark.parametrize("length", [400, 1200])
def test_long_byte_windows(spark, length):
    draw = random.Random(length)
    text = "".join(draw.choice("abcdefgh ") for _ in range(4000))
    given = [(1, text), (2, "x" + text[100:3900] + "y"), (3, text[: length - 1])]
    found = {r.doc_id: r.n_removed for r in suffix.remove_strings(spark.createDataFrame(given, "doc_id long, text string"), length).collect()}
    assert found == same_as([(i, t.encode()) for i, t in given], length, False) and found[2] == 3800


@pytest.mark.parametrize("length", [500, 1500])
def test_long_word_windows(spark, length):
    draw = random.Random(length)
    words = tuple(f"w{draw.randrange(900)}" for _ in range(5000))
    given = [(1, words), (2, ("one", *words, "two")), (3, words[: length - 1])]
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in given], "doc_id long, text string")
    found = {r.doc_id: r.n_removed for r in debruijn.remove_passages(table, length).collect()}
    assert found == same_as(given, length, True) and found[2] == 5000


def test_windows_too_long_are_refused(spark):
    table = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    with pytest.raises(ValueError):
        suffix.remove_strings(table, 100_000)
    with pytest.raises(ValueError):
        debruijn.remove_passages(table, 100_000)


REPEATED = [(1, "a b", "x"), (1, "c d", "y"), (2, None, "z"), (2, "e", "t"), (3, "f g", "u"), (3, "f g", "u"), (4, "h", "v"), (None, "i", "w")]


def test_one_row_of_each_id(spark):
    """The row with the smallest text stands, whole."""
    table = spark.createDataFrame(REPEATED, "doc_id long, text string, bucket string")
    whole = {(1, "a b", "x"), (2, None, "z"), (3, "f g", "u"), (4, "h", "v")}
    for chosen in (one_per_id(table), debruijn.without_passages(table), jaccard.representatives(table)):
        assert sorted(map(tuple, chosen.collect())) == sorted(whole)
    long = [(i, f"{t} " + " ".join(f"w{k}" for k in range(60)) if t else t, b) for i, t, b in REPEATED]
    kept = quality.keep(spark.createDataFrame(long, table.schema), None).collect()
    assert sorted((r.doc_id, r.bucket) for r in kept) == [(1, "x"), (3, "u"), (4, "v")]


@pytest.mark.parametrize("size", [16, 1 << 16])
def test_equal_rows_are_encoded_apart(spark, size):
    text = "these words are longer than a chunk of sixteen"
    given = [(1, text), (1, text), (1, "other"), (2, text), (2, None), (2, ""), (3, "x y")]
    model = public_tokenizers.path("piece_bpe_32k.model")
    single = {t: pieces.round_trip(spark.createDataFrame([(9, t)], "doc_id long, text string"), model, size).first()[1:] for t in {t for _, t in given}}
    found = pieces.round_trip(spark.createDataFrame(given, "doc_id long, text string").repartition(3), model, size).collect()
    assert sorted((r.doc_id, *r[1:]) for r in found) == sorted((i, *single[t]) for i, t in given)


def test_pipeline_with_nulls_empties_and_repeats(spark, tmp_path):
    """Planted null, empty, repeated and copied rows through all four stages."""
    draw = random.Random(3)
    prose = lambda n: " ".join(f"{draw.choice(['corn', 'ship', 'trade', 'money'])}{draw.randrange(500)}" for _ in range(n))
    passage = prose(40)
    texts = [(k, prose(80)) for k in range(1, 20)] + [(30, None), (31, ""), (32, None), (33, "too short")]
    texts += [(40, texts[0][1]), (41, f"{prose(70)} {passage}"), (42, f"{passage} {prose(70)}"), (5, "zz " + prose(90)), (5, texts[4][1])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, home string"
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), "h") for i, t in texts], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    sizes = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        sizes[r.doc_id] = r.doc_tokens
    assert set(sizes) == set(range(1, 20)) | {41, 42}
    assert sizes[42] < sizes[41]
    whole = {r.doc_id: r.doc_tokens for r in packing.pack_documents(spark.createDataFrame([(5, texts[4][1])], "doc_id long, text string"), public_tokenizers.path("word_bpe_49k.json")).collect()}
    assert sizes[5] == whole[5]
