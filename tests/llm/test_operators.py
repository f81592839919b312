"""Operators against brute force on small tables: nulls, empty texts, repeated rows, empty tables, other columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from curiospark.llm import bpe, decontaminate, licenses, lm, near, quality, substrings, token_files, topk, warc

rng = random.Random(11)
WORDS = [f"w{k}" for k in range(300)]
BASE = [" ".join(rng.choice(WORDS) for _ in range(n)) for n in (3, 8, 60, 120, 400)]
TEXTS = [None, "", "  \n", "Déjà <|endoftext|> vu's 12", *BASE, BASE[2], BASE[2].upper(), BASE[3].replace("w1 ", "zz ", 1), BASE[4][200:900] + " tail", "x" * 20_000, *BASE[2:4]]
SCHEMA = "doc_id long, text string, n_words string, spans int, bucket int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(k, t, "other", 1, 2) for k, t in enumerate(TEXTS)], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def split(text, lower=False):
    text = text or ""
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text) if lower else text)


def test_substrings(docs, none):
    seen, want = set(), {}
    for k, t in enumerate(TEXTS):
        w, gone = split(t), set()
        for i in range(len(w) - 19):
            if tuple(w[i : i + 20]) in seen:
                gone.update(range(i, i + 20))
            seen.add(tuple(w[i : i + 20]))
        want[k] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.dedup_substrings(docs).collect()}
    assert got == want
    assert substrings.dedup_substrings(none).count() == 0


def removed_by_brute_force(rows):
    """Of rows (id, text): how many words go, by row; rows with one id are one document."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    first = {}
    for k in order:
        w = split(rows[k][1])
        for i in range(len(w) - 19):
            name, place = tuple(w[i : i + 20]), (rows[k][0] is None, rows[k][0] or 0, i)
            first[name] = min(first.get(name, place), place)
    out = []
    for doc_id, t in rows:
        w, gone = split(t), set()
        for i in range(len(w) - 19):
            if first[tuple(w[i : i + 20])] < (doc_id is None, doc_id or 0, i):
                gone.update(range(i, i + 20))
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def many_repeats():
    r = random.Random(4)
    passages = [" ".join(r.choice(WORDS) for _ in range(n)) for n in (19, 20, 21, 45, 90)]
    rows = []
    for k in range(120):
        parts = [r.choice(passages) if r.random() < 0.6 else " ".join(r.choice(WORDS) for _ in range(r.randrange(30))) for _ in range(r.randrange(6))]
        rows.append((r.choice([None, *range(90)]), " ".join(parts)))
    return rows + [rows[0], rows[5], (7, None), (None, ""), (-4, rows[8][1])]


@pytest.mark.parametrize("fan, slice_bytes", [(4096, 1 << 23), (2, 300)])
def test_substrings_of_repeated_and_null_ids(spark, fan, slice_bytes):
    rows = many_repeats()
    clash = [(k, t, "a", 1.0, 2, "b", None, "d") for k, t in rows]
    table = spark.createDataFrame(clash, "doc_id long, text string, kept string, tell double, spans int, t string, factors string, `a b.c` string").repartition(5)
    found = substrings.dedup_substrings(table, ("kept", "tell", "spans", "t", "factors", "a b.c"), fan=fan, slice_bytes=slice_bytes).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found), key=str) == removed_by_brute_force(rows)
    assert {tuple(r.carried) for r in found} == {("a", 1.0, 2, "b", None, "d")}
    texts = {}
    for k, t in rows:
        texts.setdefault(k, []).append(split(t))
    for r in found:  # every factor also stands at its source, which is earlier
        for f in r.factors:
            assert (f.source is None, f.source or 0, f.source_start) < (r.doc_id is None, r.doc_id or 0, f.start) and f.words >= 20
            assert any(own[f.start : f.start + f.words] == other[f.source_start : f.source_start + f.words] for own in texts[r.doc_id] for other in texts[f.source])


def test_factors_are_the_longest_earlier_runs():
    r = np.random.default_rng(2)
    key, run = r.integers(0, 3, 400).astype(np.uint64), np.repeat(np.arange(50), 8)
    rank = np.arange(400) // 2
    begin, size, source, _ = substrings.factor(key, run, rank)
    at = 0
    for a, n, c in [*zip(begin, size, source), (400, 0, 0)]:
        for i in range(at, a):  # no factor starts at a window that is left out
            assert not any(key[j] == key[i] and rank[j] < rank[i] for j in range(400))
        if n:
            reach = lambda i, j: next((m for m in range(8) if max(i, j) + m >= 400 or run[i + m] != run[i] or run[j + m] != run[j] or key[i + m] != key[j + m]), 8)
            assert rank[c] < rank[a] and n == max(reach(a, j) for j in range(400) if rank[j] < rank[a]) == reach(a, c)
        at = a + n


def test_dealt_bytes_stay_in_proportion():
    """Bytes dealt for a slice, by the number of blocks: at most half more at a hundred times as many."""
    r = random.Random(9)
    texts = [" ".join(r.choice(WORDS) + r.choice(WORDS) for _ in range(150)) for _ in range(600)]
    array, n = pa.array(texts, pa.large_string()), sum(map(len, texts))
    ids, null, tells = np.arange(600), np.zeros(600, np.uint8), np.arange(600).astype(np.uint32)
    for dealt in (lambda k: substrings.deal(ids, null, tells, array, k, 67), lambda k: [near.deal(array, k)]):
        few, many = (sum(b.nbytes for b in dealt(k)) / n for k in (64, 6400))
        assert many < 2 and many < 1.6 * few


def test_near_groups(docs, none):
    sets = []
    for t in TEXTS:
        w = split(t, True)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    comp = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((comp[a], comp[b]))
                comp = [low if c == high else c for c in comp]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.near_groups(docs).collect()}
    assert got == {k: (len(s), comp[k]) for k, s in enumerate(sets)}
    assert near.near_groups(none).count() == 0


def test_signatures_meet():
    r = np.random.default_rng(3)
    for _ in range(500):
        a = np.unique(r.integers(0, 1 << 63, int(np.exp(r.uniform(1.4, 6))), dtype=np.uint64))
        b = a.copy()
        k = int(r.integers(0, max(2, len(a) // 6)))
        b[:k] = r.integers(0, 1 << 63, k, dtype=np.uint64)
        b = np.unique(b)
        if near.similar(a, b) and not np.array_equal(a, b):
            needed = np.full(2, 1 << 30)
            sig, at = near.signatures([a, b], needed=needed)
            assert len(set(sig[at == 0].tolist()) & set(sig[at == 1].tolist())) >= needed.max()


def test_bpe(docs, none):
    path = token_files.tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    for r in bpe.encode_decode(docs, path).collect():
        want = library.encode(TEXTS[r.doc_id] or "", add_special_tokens=False).ids
        assert (list(r.ids), r.decoded) == (want, library.decode(want, skip_special_tokens=False))
    assert bpe.encode_decode(none, path).count() == 0


def test_token_files(docs, none):
    path = token_files.tokenizer_path("byte_bpe_50k.json")
    library, start = Tokenizer.from_file(path), 0
    got = {r.doc_id: r for r in token_files.read_token_files(token_files.write_token_files(docs, path)).collect()}
    for k, t in enumerate(TEXTS):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        assert (got[k].start, list(got[k].ids), got[k].ids_crc32) == (start, ids, zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert token_files.read_token_files(token_files.write_token_files(none, path)).count() == 0
    with pytest.raises(ValueError):
        token_files.unframe(token_files.frame(b"payload")[:-1] + b"?", 0)


def test_decontaminate(spark, docs, none):
    items = [(1, BASE[2]), (2, "w1 w2"), (3, None), (4, ""), (5, BASE[2]), (None, "zz"), (6, "W1! w2..."), (11, BASE[4][300:500])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    alnum = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for k, t in items:
        w = alnum(t)
        for i in range(max(1, len(w) - 7) if w else 0):
            windows.setdefault(tuple(w[i : i + 8]), set()).add(k)
    want = {}
    for k, t in enumerate(TEXTS):
        w, hit, found = alnum(t), set(), set()
        for name, ids in windows.items():
            for i in range(len(w) - len(name) + 1):
                if tuple(w[i : i + len(name)]) == name:
                    hit.update(range(i, i + len(name)))
                    found |= ids - {None}
        bits = bytes(np.packbits([i in hit for i in range(len(w))])) if hit else b""
        want[k] = (len(w), len(hit), sorted(map(str, found)), bits)
    for most in (200_000, 7, 1):
        got = decontaminate.decontaminate(docs, bench, most=most, carry=("doc_id", "n_words", "spans")).collect()
        assert {r.carried.doc_id: (r.n_words, r.n_hit, r["items"], bytes(r.hits)) for r in got} == want
    assert decontaminate.decontaminate(none, bench).count() == 0 and decontaminate.decontaminate(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_top_k(spark):
    r = np.random.default_rng(1)
    rows = [(k, r.standard_normal(8).tolist(), "x") for k in range(300)] + [(300 + k, [0.5] * 8, "x") for k in range(40)]
    rows += [(0, [0.25] * 8, "x"), (50, rows[50][1], "x"), (7, rows[7][1], "x"), (400, [1e300, -1e300] * 4, "x"), (401, [3e9] * 8, "x"), (450, [-2e14, 2e14] * 4, "x")]
    bad = [(900, None, "x"), (901, [1.0, None] * 4, "x"), (902, [float("nan")] * 8, "x"), (903, [float("-inf")] * 8, "x"), (950, [1.0], "x"), (None, [0.1] * 8, "x")]
    v = topk.integers(spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, score string"))
    clamp = lambda x: max(-topk.LIMIT, min(topk.LIMIT, x))
    good = [(k, [clamp(math.floor(min(max(256 * y, -1e300), 1e300))) for y in x]) for k, x, _ in rows]
    want = []
    for i, (q, x) in enumerate(good):
        if q % 50 == 0:
            found = sorted((-clamp(sum(a * b for a, b in zip(x, y))), c) for j, (c, y) in enumerate(good) if j != i)[:5]
            want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(found)]
    for block in (4096, 3):
        assert sorted(tuple(x) for x in topk.top_k(v, v.where("vec_id % 50 = 0"), block=block).collect()) == sorted(want)
    assert topk.top_k(v.limit(0), v.limit(0)).count() == 0


def test_warc(spark):
    html = "é" * 80
    pages = spark.createDataFrame([(3, "http://a/\n", html), (1, None, html), (2, "u", None), (4, "u", "short"), (5, "u", "short"), (6, "u", "a\r\n\r\nWARC/1.1\r\n" * 99)], "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.records(warc.read_chunks(warc.write_archives(pages), chunk_bytes=64)).collect()}
    for k, t in ((1, html), (2, ""), (4, "short"), (6, "a\r\n\r\nWARC/1.1\r\n" * 99)):
        assert (got[k].payload_bytes, got[k].payload_digest, got[k].refers_to, got[k].intact) == (len(t.encode()), hashlib.sha256(t.encode()).hexdigest(), None, True)
    assert (got[3].record_type, got[3].refers_to, got[3].payload_bytes) == ("revisit", 1, 160) and got[5].record_type == "response"
    assert warc.read_chunks(warc.write_archives(pages.limit(0))).count() == 0


def test_quality(spark, docs, none):
    x = np.random.default_rng(0).random((400, len(quality.FEATURES)))
    y = (x[:, 0] > x[:, 1]).astype(float)
    assert ((quality.fit(x, y).score(x) > 0.5) == y).mean() > 0.95
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(8)], "doc_id long, quality int, toxic int")
    assert quality.score(docs, quality.train(docs, labels)).where("score between 0 and 1").count() == len(TEXTS)
    assert quality.score(none, quality.train(none, labels)).count() == 0


def shuffled_bytes(spark):
    sc, gateway = spark.sparkContext._jsc.sc(), spark.sparkContext._gateway
    sc.listenerBus().waitUntilEmpty(30_000)
    stages = sc.statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))


def test_quality_learns_one_text_of_an_id_and_shuffles_none(spark):
    r = random.Random(5)
    # Every third id has two texts, every fifth has its text twice; a text has some 20 KB that hardly compress.
    rows = [(k, " ".join(f"{r.getrandbits(64):x}" + "!" * (k % 2) for _ in range(1200))) for k in (*range(150), *range(0, 150, 3))]
    rows += [x for x in rows[:150] if x[0] % 5 == 0]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(140)], "doc_id long, quality int, toxic int")
    learned = {}
    for d, t, tell in docs.select("doc_id", "text", F.xxhash64("text")).collect():
        if d < 140 and zlib.crc32(str(d).encode()) % 5:
            learned[d] = min(learned.get(d, (tell, t)), (tell, t))
    x = quality.features(pa.array([t for _, t in learned.values()], pa.large_string()))
    y = np.array([d % 2 for d in learned], float)
    order = np.lexsort((y, *x.T))
    want = quality.fit(x[order], y[order])
    docs = docs.localCheckpoint()
    before = shuffled_bytes(spark)
    got = quality.train(docs, labels)
    assert shuffled_bytes(spark) - before < sum(len(t) for _, t in learned.values()) / 20
    assert got.base == want.base and all(np.array_equal(a, b) for a, b in zip(got.tables, want.tables, strict=True))
    assert [(a, b) for a, b, _ in got.pairs] == [(a, b) for a, b, _ in want.pairs] and all(np.array_equal(a[2], b[2]) for a, b in zip(got.pairs, want.pairs))


def test_language_model(spark, docs, none):
    rows = [*enumerate(TEXTS), (None, BASE[1]), (3, BASE[2]), (3, "w1 w2")]
    fold = lambda k: k is None or zlib.crc32(str(k).encode()) % 7 == 2
    seen = Counter(t for k, x in rows if not fold(k) for t in [*split(x, True), None])
    total, places = sum(seen.values()), sum(seen.values()) + len(seen) + 1
    want = []
    for k, x in rows:
        own = [*split(x, True), None]
        want.append((str(k), fold(k), len(own), sum(seen[t] > 0 for t in own), total, round(sum(math.log10((seen[t] + 1) / places) for t in own), 6)))
    table = spark.createDataFrame([(k, x, 1) for k, x in rows], "doc_id long, text string, score int")
    got = lm.score_corpus(table).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(want)
    assert all(r.score < 0 for r in got)
    other = lm.score_corpus(table.orderBy(F.desc("doc_id")).repartition(3)).collect()
    assert sorted((str(r.doc_id), r.n_tokens, round(r.score, 6)) for r in got) == sorted((str(r.doc_id), r.n_tokens, round(r.score, 6)) for r in other)
    assert lm.score_corpus(none).count() == 0


def test_language_model_is_normalised():
    r = np.random.default_rng(5)
    model = lm.LogBilinear(np.full(lm.SYMBOLS, 1 / lm.SYMBOLS))
    s, a, b = (r.integers(0, lm.SYMBOLS, 9000) for _ in range(3))
    model.learn(s, a, b, {k: np.full_like(v, 1e-3) for k, v in model.parts.items()}, r)
    normal, every = model.normaliser(), np.arange(lm.SYMBOLS)
    for near, far in ((0, 0), (5, 900), (1023, 17)):
        assert abs(sum(10 ** model.log10(every, np.full(lm.SYMBOLS, near), np.full(lm.SYMBOLS, far), normal)) - 1) < 1e-4


def test_language_model_words_within_classes():
    """Shares in context sum to one over a class's words and its unknown one; words that go with a symbol rise after it."""
    r = np.random.default_rng(6)
    counts = np.append(np.arange(3000, 0, -1), 50)
    hashes = np.append(r.permutation(1 << 20)[:3000].astype(np.uint64), lm.END)
    classes = np.append(np.arange(3000) % 3, 0)
    by_class = np.array([[sum(f(k) for k in range(lm.FREQUENT, 3000) if k % 3 == c) for c in range(lm.RARE)] for f in (lambda k: counts[k], lambda k: 1)])
    vocab = lm.Vocabulary(hashes, counts, classes, int(counts.sum()), 3001, by_class)
    own = len(vocab.member_counts)
    assert own == 3000 - lm.FREQUENT - (lm.MEMBER_LEAST - 1)
    members, word = lm.Members(own), r.integers(0, own, 60_000)
    after = np.where(word < own // 2, 5, 9)
    members.learn(word, after, vocab.member_class[word].astype(np.int64), members.start(), r)
    normal = members.normaliser(vocab)
    for c in (0, 1, 2, 100):
        inside = np.flatnonzero(vocab.member_class == c)
        n = np.concatenate((vocab.member_counts[inside], [k for k in range(1, lm.MEMBER_LEAST) if (3000 - k) % 3 == c], [0]))
        which = np.concatenate((inside, np.full(len(n) - len(inside), -1)))
        for near in (0, 5, 9):
            logs = np.log10((n + 1) / (by_class[:, c].sum() + 1)) + members.log10(which, np.full(len(n), near), np.full(len(n), c), normal)
            assert abs((10**logs).sum() - 1) < 1e-4
    one = np.arange(own)
    gain = lambda near: members.log10(one, np.full(own, near), vocab.member_class.astype(np.int64), normal)
    assert (gain(5) > gain(9)).tolist() == (one < own // 2).tolist()


def test_licenses(spark, none):
    rows = [(k, f"text\n{n}.\n", c) for c, notices in licenses.NOTICES.items() for k, n in enumerate(notices)] + [(9, t, None) for t in licenses.NEAR_MISSES] + [(9, None, None), (9, "", None)]
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, family string")).collect():
        assert {f.family for f in r.findings} - {"unknown"} == ({r.family} if r.family else set())
    assert licenses.scan(none).count() == 0


#: Wordings, versions and ids; all but CC0's id are no templates, though the fit sees some of them.
DECLARED = {
    "agpl": ("This program is distributed under the GNU AGPL version 3.", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    "apache": ("Released under the Apache License 2.0", "Distributed under the terms of version 2.0 of the Apache License", "SPDX-License-Identifier: Apache-1.1"),
    "bsd": ("Licensed under the BSD 2-Clause License", "Published under a 3-clause BSD license", "SPDX-License-Identifier: BSD-2-Clause"),
    "cc-by": ("Available under CC BY 3.0", "SPDX-License-Identifier: CC-BY-2.5"),
    "cc-by-nc": ("Shared under the Creative Commons Attribution-NonCommercial 3.0 licence", "Released under CC BY-NC 2.0"),
    "cc-by-sa": ("Text is available under the Creative Commons Attribution-ShareAlike License", "CC BY-SA 3.0"),
    "cc0": ("The data is available under CC0", "SPDX-License-Identifier: CC0-1.0"),
    "gpl": ("Licensed under the GNU General Public License, version 3", "Released under the GPLv2", "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "It is published under\nthe terms of the GNU\nGeneral Public License"),
    "lgpl": ("SPDX-License-Identifier: LGPL-2.1", "This library is released under the GNU Lesser General Public License, version 2.1"),
    "mit": ("Licensed under the MIT License", "The MIT License (MIT)", "License: MIT", "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software"),
    "mpl": ("Licensed under the Mozilla Public License 1.1", "SPDX-License-Identifier: MPL-1.1"),
    "proprietary": ("Copyright 2020 Example Ltd. All rights are reserved.", "Unauthorised copying of these pages is forbidden"),
}
UNDECLARED = (
    "The MIT laboratory was licensed by the city", "Not licensed under the MIT License", "Licensed under CC BY-NC-SA 4.0", "Licensed under CC BY-ND 4.0", "The general public may copy the form",
    "The Apache nation released a statement", "Licensed under the Eclipse Public License", "Licensed under\n\nthe MIT License of somebody else", "The GPL is often compared with other licenses",
)


def test_licenses_in_other_words(spark):
    rows = [(f"Some text.\n{n}\nMore text.", c) for c, notices in DECLARED.items() for n in notices] + [(t, None) for t in UNDECLARED]
    rows += [("GPL-2.0 code.\nLicensed under the MIT License.\nReleased under\nthe Apache License 2.0", "mit,apache")]
    wrong = []
    for r in licenses.scan(spark.createDataFrame(rows, "text string, family string")).collect():
        found = [f.family for f in r.findings if f.family != "unknown"]
        if found != (r.family.split(",") if r.family else []):
            wrong.append((r.text, r.family, [(f.paragraph, f.family, round(f.probability, 2)) for f in r.findings]))
    assert not wrong
