"""The pipeline against brute force, stage by stage."""

import os
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from larkspur.llm import quality

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


def test_pipeline(spark):
    source = spark.read.parquet(f"{DATA}/documents.parquet")
    trees = quality.fit(source, spark.read.parquet(f"{DATA}/labels.parquet"))
    passed = {r.doc_id for r in quality.judge(source, trees).collect() if r.kept}
    texts = {r.doc_id: r.text for r in source.collect() if r.doc_id in passed}
    word = re.compile(r"[^\x20\x09-\x0D]+")
    sets = {}
    for i, t in texts.items():
        w = word.findall(t.lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    label = {i: i for i in sets}
    for _ in sets:
        before = dict(label)
        for a in sets:
            for b in sets:
                if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
        if before == label:
            break
    seen, expected = set(), {}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i in sorted(i for i in label if label[i] == i):
        w = word.findall(texts[i])
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            window = tuple(w[k : k + 20])
            if window in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(x for x, g in zip(w, gone) if not g) if any(gone) else texts[i]
        expected[i] = len(tokenizer.encode(kept, add_special_tokens=False).ids) + 1
    found = {}
    for r in corpus_pipeline.run(spark, DATA).collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
        assert r.doc_tokens == expected[r.doc_id]
    assert found == expected
