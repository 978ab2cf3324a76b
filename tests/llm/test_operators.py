"""The operators against brute force on small tables with nulls, empty and long texts, ties, copies and clashing columns."""

import dataclasses
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from larkspur.llm import arrays as A, dac, debruijn, hmm, jaccard, licences, packing, pieces, quality, repeats, suffix, topk
from larkspur.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, n_words long, bucket string, _home int, n_chars long"


def prose(draw, words):
    return " ".join(draw.choice(["the", "Und", "lächeln", "tion", "ER", "x", "日本", "na na", "*", "don't"]) + str(draw.randrange(40)) for _ in range(words))


def texts():
    draw = random.Random(5)
    base, passage = prose(draw, 120), prose(draw, 30)
    near = base.split(" ")
    near[60] = "other"
    out = [base, base, " ".join(near), None, "", "  \n\t ", "one", "one", "ONE", passage + " tail", "head " + passage + "\n\nend", prose(draw, 4000), "ab" * 80, "ab" * 80, "a b c d e f", "A b c d e f g"]
    out += [prose(draw, 12) + "\n" + passage + "\n" + passage, "Released under the MIT License.\nx", "gnu general public\nlicense", "a  b\x01c   d▁e <|endoftext|> é"]
    out += [base.upper(), "x y " * 100] + [prose(draw, draw.randrange(1, 60)) for _ in range(20)]
    return list(enumerate(out, 3))


TEXTS = texts()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 1, "b", 2, len(t or "")) for i, t in TEXTS] + [(None, "no id", 1, "b", 2, 5)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def removed_places(sequence, length, seen, owner, same_document):
    """Which elements lie in a window that started before; seen holds the owner of each window's first place."""
    gone, mine = [False] * len(sequence), []
    for i in range(len(sequence) - length + 1):
        window = sequence[i : i + length]
        if window in seen and (same_document or seen[window] != owner):
            gone[i : i + length] = [True] * length
        seen.setdefault(window, owner)
    return gone


def test_suffix_dedup(docs, nothing):
    found, seen = rows(suffix.remove_strings(docs)), {}
    assert len(found) == len(TEXTS)
    for i, text in TEXTS:
        data = (text or "").encode()
        gone = removed_places(data, 50, seen, i, False)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        assert found[i][1:] == (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    assert suffix.remove_strings(nothing).count() == 0


@pytest.mark.parametrize("length", [20, 33, 50, 101])
def test_difference_cover_groups(length):
    draw = np.random.default_rng(length)
    text = draw.integers(97, 99, 3000).astype(np.uint8)
    text[1500:2400] = text[200:1100]
    at = np.arange(0, len(text) - length)
    doc = at // 700
    first = suffix.first_windows(text, at, doc, at, length)
    seen = {}
    for k, p in enumerate(at):
        assert first[k] == seen.setdefault(text[p : p + length].tobytes(), k)


def test_substring_dedup(docs, nothing):
    found, back, seen = rows(debruijn.remove_passages(docs)), rows(debruijn.without_passages(docs)), {}
    for i, text in TEXTS:
        words = tuple(WORD.findall(text or ""))
        gone = removed_places(words, 20, seen, i, True)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        assert found[i][1:] == (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
        assert back[i].text == (kept if any(gone) else text)
        assert back[i].bucket == "b" and back[i].n_words == 1
    assert debruijn.remove_passages(nothing).count() == 0


def test_long_passages_only(spark):
    draw = random.Random(1)
    short, long = prose(draw, 22), prose(draw, 60)
    table = spark.createDataFrame([(1, f"{short} one {long}"), (2, f"{short} two"), (3, f"three {long}")], "doc_id long, text string")
    found = rows(debruijn.remove_passages(table, 20, 40))
    assert found[2].n_removed == 0 and found[3].n_removed == len(WORD.findall(long))


def test_repeated_ids(spark):
    table = spark.createDataFrame([(1, "b" * 60), (1, "a" * 60), (2, "a" * 60), (2, "a" * 60)], "doc_id long, text string")
    found = rows(suffix.remove_strings(table))
    assert found[1].n_removed == 0 and found[2].n_removed == 60 and len(found) == 2


@pytest.mark.parametrize("module, length, same_document", [(suffix, 50, False), (debruijn, 20, True)])
def test_hot_anchors_are_dealt_on(spark, monkeypatch, module, length, same_document):
    """A phrase shorter than a window in many documents; no comparison gets the windows of all of them."""
    draw = random.Random(4)
    phrase, passage = " ".join(f"p{k}" for k in range(12 if same_document else 6)), prose(draw, 30)
    given = [(k, f"{prose(draw, 12)} {phrase} {passage + ' ' if k % 9 == 0 else ''}{draw.choice(['a b', 'c'])} {prose(draw, 12)}") for k in range(300)]
    given += [(400 + k, given[k][1][7:] + " more") for k in range(0, 300, 50)]
    rule_of, compare = module.rule_of, module.first_windows

    def bounded(elements, at, *more):
        if len(at) > 1500:
            raise ValueError(f"{len(at)} windows meet")
        return compare(elements, at, *more)

    monkeypatch.setattr(module, "first_windows", bounded)
    if hasattr(repeats, "HOT"):
        monkeypatch.setattr(module, "rule_of", lambda n: dataclasses.replace(rule_of(n), most=16))
    table = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    found, seen = rows(suffix.remove_strings(table) if module is suffix else debruijn.remove_passages(table)), {}
    for i, text in given:
        whole = tuple(WORD.findall(text)) if same_document else text.encode()
        gone = removed_places(whole, length, seen, i, same_document)
        kept = [x for x, g in zip(whole, gone) if not g]
        assert found[i].n_removed == sum(gone)
        assert found[i].kept_sha256 == hashlib.sha256(" ".join(kept).encode() if same_document else bytes(kept)).hexdigest()


def shingle_sets():
    out = {}
    for i, text in TEXTS:
        words = WORD.findall((text or "").translate(ASCII_LOWER))
        out[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
    return out


def test_jaccard_join(docs, nothing):
    sets = shingle_sets()
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * common >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    found = rows(jaccard.join_documents(docs))
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == {i: (len(s), label[i]) for i, s in sets.items()}
    kept = rows(jaccard.representatives(docs))
    assert set(kept) == {i for i in label if label[i] == i} and kept[3].bucket == "b"
    assert jaccard.join_documents(nothing).count() == 0


def test_jaccard_of_many_near_copies(spark):
    draw = random.Random(8)
    words = [f"w{k}" for k in range(70)]
    texts = []
    for _ in range(150):
        own = words[: draw.choice([6, 9, 14, 22, 70])]
        for _ in range(draw.choice([0, 1, 1, 2, 3])):
            own[draw.randrange(len(own))] = f"z{draw.randrange(300)}"
        texts.append(" ".join(own))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t in texts]
    label = list(range(len(sets)))
    for _ in range(len(sets)):
        before = list(label)
        for a in range(len(sets)):
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    found = rows(jaccard.join_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert [found[k].component_id for k in range(len(texts))] == label


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(60, 50), (55, 60), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(41)}, 50: 50, 55: 50, 60: 50}


def test_topk(spark):
    draw = np.random.default_rng(3)
    vectors = [[float(x) for x in v] for v in draw.normal(size=(300, 12)) * draw.exponential(size=(300, 1))]
    vectors[7] = vectors[50] = vectors[100]
    table = [(k, v, "x") for k, v in enumerate(vectors)] + [(400, None, "x"), (450, [1.0, None], "x"), (500, [float("nan")] * 12, "x"), (550, [float("inf")] * 12, "x"), (None, vectors[0], "x"), (600, [2.0], "x")]
    found = {}
    frame = spark.createDataFrame(table, "vec_id long, embedding array<double>, score string")
    for r in topk.search(frame).collect():
        found.setdefault(r.query_id, {})[r["rank"]] = (r.score, r.vec_id)
    whole = {k: [math.floor(256 * x) for x in v] for k, v in enumerate(vectors)} | {600: [512] + [0] * 11}
    queries = [k for k in whole if k % 50 == 0]
    assert set(found) == set(queries)
    for q in queries:
        best = sorted((-sum(a * b for a, b in zip(whole[q], v)), k) for k, v in whole.items() if k != q)[:5]
        assert [found[q][n] for n in range(1, 6)] == [(-s, k) for s, k in best]
    assert topk.search(frame.where("vec_id > 400 and vec_id < 600")).count() == 0


def test_licences(docs, nothing):
    found = rows(licences.scan(docs))
    for i, text in TEXTS:
        words = re.findall(licences.WORD, (text or "").translate(ASCII_LOWER))
        hits = sorted((k, label) for phrase, label in licences.PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split())
        assert found[i][1:5] == (len(words), len(hits), hits[0][0] if hits else None, hits[-1][0] if hits else None)
        assert found[i].base_labels == ",".join(sorted({label for _, label in hits}))
    assert sum(r.n_base for r in found.values()) == 2
    assert licences.scan(nothing).count() == 0


def test_licence_templates(spark):
    near = "This work was licensed under GNU General Public License version 3"
    found = rows(licences.scan(spark.createDataFrame([(1, f"x\n{near}"), (2, "licensed under the"), (3, "Licensed under CC BY-NC 4.0.")], "doc_id long, text string")))
    assert found[1].labels == "gpl" and found[2].labels == "" and found[2].score == 0 and found[3].labels == "cc-by-nc" and found[3].score == 1


def test_licence_notices_over_lines(spark):
    """All texts in all wrappings against a search of the lines and of each window over line breaks."""
    bsd = "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions are met:"
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal"
    starred = "/*\n * " + mit.replace("\n", "\n *\n * ") + "\n */"
    given = [bsd, mit, bsd.replace("\n", "\n#\n"), bsd.replace("\n", "\r\n"), "before\n\n" + mit + "\nafter\n", "Released under\nthe MIT", "released\n" + "x " * 40 + "under the mit", starred, mit.replace("\n", "\n \t\n")]
    draw = random.Random(3)
    for _, text in licences.TEMPLATES:
        for most in (1, 3, 8):
            words = [w for w in text.split() if draw.random() < 0.9]
            words.insert(draw.randrange(len(words)), "inserted")
            words = ["some", "words", "ahead"] * draw.randrange(12) + words + ["more"] * draw.randrange(40)
            given.append("".join(w + draw.choice(["\n"] + [" "] * most) for w in words))
    given = list(enumerate(given))
    found = rows(licences.scan(spark.createDataFrame(given, "doc_id long, text string")))
    assert [found[k].labels for k in range(7)] == ["bsd", "mit", "bsd", "bsd", "mit", "mit", ""]
    assert [found[k].labels for k in (7, 8)] == ["mit", ""]
    for i, text in given:
        lines = [re.findall(licences.WORD, x.translate(ASCII_LOWER)) for x in text.split("\n") if re.findall(licences.WORD, x.translate(ASCII_LOWER)) or not x.strip()]
        paragraphs = [[]]
        for line in lines:
            paragraphs = [*paragraphs[:-1], paragraphs[-1] + line] if line else [*paragraphs, []]
        best = {}
        for (label, template) in licences.TEMPLATES:
            holds, width = set(template.split()), math.ceil(len(template.split()) / licences.THRESHOLD)
            windows = lines + [p[k : k + width] for p in paragraphs for k in range(len(p))]
            best[label] = max(best.get(label, 0), max(len(holds & set(w)) / len(holds) for w in windows))
        expected = {label for label, share in best.items() if share >= licences.THRESHOLD}
        assert set(found[i].labels.split(",")) - {""} - set(found[i].base_labels.split(",")) == expected - set(found[i].base_labels.split(",")), text
        if not found[i].n_base:
            assert found[i].score == max([share for share in best.values() if share >= licences.THRESHOLD], default=0), text


def test_quality(docs, nothing, spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in TEXTS] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    found = rows(quality.judge(docs, quality.fit(docs, labels)))
    for i, text in TEXTS:
        text = text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        repeat = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
        expected = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeat))
        assert found[i][1:6] == expected
        assert found[i].base_failed == (len(words) < 50 or 100 * len(repeat) > 50 * len(words))
        assert not (found[i].kept and found[i].base_failed)
    assert quality.fit(docs, labels.limit(0)) is None and quality.judge(nothing, None).count() == 0
    assert rows(quality.keep(docs, None))[3].bucket == "b"


def test_trees_are_monotonic_and_learn():
    draw = np.random.default_rng(2)
    x = draw.random((4000, 3))
    y = ((x[:, 0] < 0.6) & (x[:, 1] + 0.2 * draw.random(4000) > 0.3)).astype(float)
    trees = quality.fit_trees(x[:3000], y[:3000], [-1, 1, 0])
    assert ((trees.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    grid = np.tile(x[:200], (20, 1))
    grid[:, 0] = np.repeat(np.linspace(0, 1, 20), 200)
    assert (np.diff(trees.score(grid).reshape(20, 200), axis=0) <= 1e-12).all()


def plain_hmm(tokens, held, rounds):
    """Baum-Welch and scores text by text, one word after the other, without windows or chunks."""
    count = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    total, kinds = sum(count.values()), len(count)
    hashes = {w: hmm.END if w == "\n" else A.words(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())])).hash[0] for w in count}
    dealt = {w: hmm.first_counts(np.array([hashes[w]]), np.array([n]))[0] for w, n in count.items()}
    start, move = np.full(hmm.STATES, 1 / hmm.STATES), hmm.first_model(np.ones(hmm.STATES), 1, 1).move
    unknown = 1 / (total + kinds + 1)
    for k in range(rounds + 1):
        sums = sum(dealt.values())
        emit = {w: (1 - hmm.KEPT) * (1 - unknown) * c / sums + hmm.KEPT * (count[w] + 1) * unknown for w, c in dealt.items()}
        scores, found = {}, {w: np.zeros(hmm.STATES) for w in count}
        first, moves = np.zeros(hmm.STATES), np.zeros((hmm.STATES, hmm.STATES))
        for i, t in tokens.items():
            e = [emit.get(w, np.full(hmm.STATES, unknown)) for w in t]
            ahead, scale = [], []
            for n, x in enumerate(e):
                v = (ahead[-1] @ move if n else start) * x
                scale.append(v.sum())
                ahead.append(v / v.sum())
            scores[i] = sum(map(math.log10, scale))
            if held[i]:
                continue
            b = np.ones(hmm.STATES)
            for n in range(len(t) - 1, -1, -1):
                found[t[n]] += ahead[n] * b
                if n:
                    moves += np.outer(ahead[n - 1], e[n] * b / scale[n]) * move
                    b = move @ (e[n] * b / scale[n])
            first += ahead[0] * b
        dealt = found
        start, move = (first + 1e-3) / (first + 1e-3).sum(), (moves + 1e-3) / (moves + 1e-3).sum(axis=1, keepdims=True)
    return scores, count, total, kinds


@pytest.mark.parametrize("rounds", [0, 2])
def test_hmm_scores(docs, nothing, rounds):
    found = rows(hmm.score_documents(docs, rounds=rounds))
    tokens = {i: [*WORD.findall((t or "").translate(ASCII_LOWER)), "\n"] for i, t in TEXTS}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    scores, count, total, kinds = plain_hmm(tokens, held, rounds)
    for i, t in tokens.items():
        assert found[i][1:5] == (held[i], len(t), sum(count[w] > 0 for w in t), total)
        assert found[i].base_score == pytest.approx(sum(math.log10((count[w] + 1) / (total + kinds + 1)) for w in t))
        assert found[i].score == pytest.approx(scores[i], rel=5e-3)  # counts are sent in steps of 1/255
    assert hmm.score_documents(nothing).count() == 0


def test_hmm_without_training_texts(spark):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2]
    found = hmm.score_documents(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score, round(r.score, 9)) for r in found} == {(3, 0, 0, 0.0, 0.0)}


def test_hmm_is_better_than_word_shares_on_texts_it_has_not_seen(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    each = []
    for n in (1, 3):
        r = hmm.score_documents(docs, rounds=n).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
        each.append(r[0])
    assert each[1] > each[0] > r[1]


def test_forward_vectors_are_carried_over_windows():
    draw = np.random.default_rng(4)
    counts = draw.integers(1, 50, (40, hmm.STATES)) / 1.0
    counts += (np.rint(counts.sum(axis=1)) - counts.sum(axis=1))[:, None] / hmm.STATES
    move = draw.dirichlet(np.ones(hmm.STATES), hmm.STATES)
    model = hmm.Model(draw.dirichlet(np.ones(hmm.STATES)), move, counts.sum(axis=0), int(counts.sum()), 40)
    emit = hmm.emissions(model, counts)
    assert emit.sum(axis=0) + model.unknown == pytest.approx(np.ones(hmm.STATES))
    lengths = np.array([1, 3, 255, 256, 257, 900, 2000])
    symbols = draw.integers(0, 40, lengths.sum())
    summed = np.zeros(emit.shape)
    found, cells = hmm.sweep(model, emit, symbols, lengths, summed)
    assert found == pytest.approx(hmm.sweep(model, emit, symbols, lengths)[0])
    for k, at in enumerate(np.cumsum(lengths) - lengths):
        state, total = model.start, 0.0
        for t, x in enumerate(symbols[at : at + lengths[k]]):
            state = (state if t == 0 else state @ move) * emit[x]
            total += math.log10(state.sum())
            state = state / state.sum()
        assert found[k] == pytest.approx(total)
    assert summed.sum(axis=1) == pytest.approx(np.bincount(symbols, minlength=40))
    assert cells[: hmm.STATES].sum() == pytest.approx(len(lengths)) and cells[hmm.STATES :].sum() == pytest.approx((lengths - 1).sum())


def library_ids(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return {i: tokenizer.encode(t or "", add_special_tokens=False).ids for i, t in TEXTS}


def test_token_files(docs, nothing, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    found, start = rows(dac.token_files(docs, path, str(tmp_path / "tokens"))), 0
    for i, ids in sorted(library_ids("byte_bpe_50k.json").items()):
        ids = np.array([*ids, 2], "<u4")
        assert found[i] == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(found) == len(TEXTS)
    assert dac.token_files(nothing, path).count() == 0


def test_codes_give_random_access():
    ids = np.random.default_rng(1).integers(0, 2 ** np.random.default_rng(2).integers(1, 32, 5000)).astype(np.uint32)
    segment = dac.Segment(dac.pack(ids))
    assert (segment.all() == ids).all() and all(segment.get(k) == ids[k] for k in range(0, 5000, 37))
    assert len(dac.Segment(dac.pack(ids[:0]))) == 0


def test_packing(docs, nothing):
    path = public_tokenizers.path("word_bpe_49k.json")
    found = packing.pack_documents(docs, path, 128).collect()
    ids = {i: np.array([*x, 1], "<u4") for i, x in library_ids("word_bpe_49k.json").items()}
    places, sequences = {i: 0 for i in ids}, {}
    for r in sorted(found, key=lambda r: (r.doc_id, r.start)):
        assert r.start == places[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        places[r.doc_id] += r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert places == {i: len(x) for i, x in ids.items()}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
    assert packing.pack_documents(nothing, path).count() == 0


def test_cuts_are_the_cheapest():
    draw = np.random.default_rng(6)
    for _ in range(30):
        ends = np.sort(draw.choice(np.arange(1, 120), 15, replace=False))
        places, cost = packing.possible_ends(int(ends[-1]), ends[::3].tolist() + [ends[-1]], ends, 20, 7)
        cuts = packing.best_cuts(places, cost, 20)
        price = dict(zip(places.tolist(), cost.tolist()))
        best = {0: 0}
        for p in places[1:].tolist():
            best[p] = min(best[q] + 20 - (p - q) + price[p] for q in places.tolist() if q < p and p - q <= 20)
        assert sum(20 - (b - a) + price[b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist())) == best[int(places[-1])]


@pytest.mark.parametrize("size", [16, 40, 1 << 16])
def test_pieces(docs, nothing, size):
    model = public_tokenizers.path("piece_bpe_32k.model")
    vocabulary = pieces.Pieces(model)
    encoded = pieces.encode(docs, model, size)
    back, score = {}, Counter()
    for r in pieces.decode(encoded, model).collect():
        back.setdefault(r.doc_id, {})[r.chunk] = r.text
        score[r.doc_id] += r.score
    for i, text in TEXTS:
        whole = pieces.SPACE + (text or "").replace(" ", pieces.SPACE) if text else ""
        assert score[i] == pytest.approx(vocabulary.forward(whole, [0.0], len(whole))[0][-1])
        assert b"".join(back[i][k] for k in sorted(back[i])) == (text or "").replace(pieces.SPACE, " ").encode()
    apart = pieces.decode(encoded, model).groupBy("doc_id", "copy").agg(F.sum("n_tokens").alias("n_tokens"), F.sum("n_byte_tokens").alias("n_byte_tokens"), F.sum(F.octet_length("text")).alias("n_bytes"), F.count("*").alias("n_chunks"))
    one = pieces.round_trip(docs, model, size).drop("score")
    assert sorted(map(tuple, apart.drop("copy").collect())) == sorted(map(tuple, one.collect()))
    assert pieces.round_trip(nothing, model).count() == 0


@pytest.mark.parametrize("size", [16, 40, 1 << 16])
def test_pieces_are_those_of_the_library(spark, size):
    import sentencepiece

    model = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    draw = random.Random(8)
    letters = ["".join(draw.choice("abcdeilnorst") for _ in range(n)) for n in (30, 49, 200, 1500)]
    more = ["des Elle", "Elle est des", "日本語のテキスト" * 20, "x" * 300 + " " * 50 + "=" * 130, "\n\n\tif (a)\n" * 30, "🙂é🙂" * 40, " lead", "trail  ", *letters]
    given = TEXTS + list(enumerate(more, 1000))
    encoded = pieces.encode(spark.createDataFrame(given, "doc_id long, text string").repartition(3), model, size)
    ids = {}
    for r in sorted(encoded.collect(), key=lambda r: r.chunk):
        ids.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    for i, text in given:
        assert ids[i] == library.encode(text or ""), text


def test_pieces_of_texts_without_a_safe_place(spark):
    """One stretch over many chunks, cut anywhere, and more chunks than one group of matrices holds."""
    import sentencepiece

    model = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    draw = random.Random(11)
    given = [(k, "".join(draw.choice(letters) for _ in range(40_000))) for k, letters in enumerate(["abcdeilnorst", "a", "=-", "日本語の漢", "é▁🙂x"])]
    encoded = pieces.encode(spark.createDataFrame([*given, given[0]], "doc_id long, text string"), model, 400).collect()
    assert {sum(r.doc_id == k for r in encoded) for k, _ in given} == {101, 202}
    for k, text in given:
        parts = {r.chunk: np.frombuffer(r.ids, "<u4").tolist() for r in encoded if r.doc_id == k}
        assert [i for c in sorted(parts) for i in parts[c]] == library.encode(text), k


def test_neighbours_that_stay_make_up_the_merged_text():
    """The rule behind the scan, both ways: all neighbours of the library's pieces stay; any other sequence of pieces has two that do not."""
    import sentencepiece

    model = public_tokenizers.path("piece_bpe_32k.model")
    library, vocabulary = sentencepiece.SentencePieceProcessor(model_file=model), pieces.Pieces(model)
    draw = random.Random(12)
    for _ in range(60):
        text = pieces.SPACE + "".join(draw.choice(draw.choice(["abest", "ion▁", "=x-"])) for _ in range(11))
        ways = [[]]
        for _ in range(len(text)):
            ways = [w + [text[len("".join(w)) : q]] for w in ways for q in range(len("".join(w)) + 1, len(text) + 1) if text[len("".join(w)) : q] in vocabulary.scores] + [w for w in ways if "".join(w) == text]
        stay = [w for w in ways if all(vocabulary.stays(a, b) for a, b in zip(["", *w], w))]
        assert [[vocabulary.piece[p] for p in w] for w in stay] == [library.encode(text[1:])]


def test_matrices_combine_in_any_order():
    vocabulary = pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    draw = random.Random(13)
    text = pieces.SPACE + "".join(draw.choice("abestion▁") for _ in range(400))
    borders = [0, 1, 60, 61, 200, 330, len(text)]
    each = [vocabulary.transfer(text, a, b) for a, b in zip(borders[:-1], borders[1:])]
    left, right = each[0], each[-1]
    for m in each[1:]:
        left = pieces.times(left, m)
    for m in each[-2::-1]:
        right = pieces.times(m, right)
    whole = vocabulary.transfer(text, 0, len(text))
    assert np.allclose(left, right) and np.allclose(left, whole) and (whole > pieces.NEVER / 2).sum() == 1
    assert whole.max() == pytest.approx(vocabulary.forward(text, [0.0], len(text))[0][-1])
