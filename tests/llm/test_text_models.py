import math
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import bloom_lm, language_id, licenses, queries
from odd_documents import SF, docs, nothing, texts  # noqa: F401

SF01 = SF.replace("sf0.001", "sf0.01")


def test_filter_never_reads_a_count_too_low():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**63, 60_000, np.uint64))
    counts = np.minimum(rng.zipf(1.6, len(keys)), 10**6)
    # Three million bits, whatever the size of a segment.
    n = 3 * 2**20 // bloom_lm._SEGMENT_BITS
    place = bloom_lm.segment_of(keys, n)
    data = np.concatenate([bloom_lm.fill_segment(keys[place == s], counts[place == s]) for s in range(n)])
    f = bloom_lm.Filter(data, n)
    got, want = f.levels(keys), bloom_lm.level_of(counts)
    assert (got >= want).all() and (got == want).mean() > 0.95
    assert (f.levels(rng.integers(0, 2**63, 20_000, np.uint64)) > 0).mean() < 0.05
    assert (bloom_lm.Filter(np.zeros(0, np.uint8), 0).levels(keys[:5]) == 0).all()
    value = bloom_lm.count_of_level()
    assert (value[bloom_lm.level_of(np.array([1, 2, 3]))] == [1, 2, 3]).all()
    assert (np.abs(np.log(value[want] / counts)) < math.log(bloom_lm.BASE)).all()


def by_hand(rows, held):
    tokens = {k: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [b" "] for k, (_, t) in enumerate(rows)}
    counts = Counter(w for k, (i, _) in enumerate(rows) if not held(i) for w in tokens[k])
    n, v = sum(counts.values()), len(counts)
    return sorted((rows[k][0] is None, rows[k][0] or 0, len(t), sum(counts[w] > 0 for w in t), n,
                   round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), 6)) for k, t in tokens.items())


@pytest.mark.parametrize("frequent", [0, 3, 10**6])
def test_base_scores_are_exact(spark, docs, frequent):
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    model, rare = bloom_lm.learn(docs.where(~held), frequent=frequent)
    got = bloom_lm.score(docs, model, rare, keep=["doc_id", "score"])
    assert got.columns == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = by_hand(rows, lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got.collect()) == want
    assert got.where("score >= 0 or score is null or isnan(score)").isEmpty()


def test_pairs_help_where_texts_recur(spark):
    got = queries.op5_bloom_lm(spark, SF01)
    base, model = got.agg(F.sum("base_score"), F.sum("score")).first()
    assert model > base
    held = got.where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert held[1] > 1.02 * held[0]


def test_little_room_leaves_out_rare_pairs_only(spark, docs):
    small, _ = bloom_lm.learn(docs, max_bits=2**20)
    full, _ = bloom_lm.learn(docs)
    assert len(small.filter.data) <= 2 * 2**17 and small.tokens == full.tokens


def counts_of(texts):
    """Counts of words, and of pairs by key, of all texts."""
    words, pairs = Counter(), Counter()
    end = bloom_lm.word_hashes([b" "])[0]
    for t in texts:
        tokens = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [b" "]
        words.update(tokens)
        pairs.update(bloom_lm.pair_keys(bloom_lm.word_hashes(tokens), end).tolist())
    return words, pairs


@pytest.mark.parametrize("max_bits", [2**14, 2**17, 2**20, 2**31])
def test_words_are_never_left_out(spark, docs, max_bits):
    words, _ = counts_of(r.text for r in docs.select("text").collect())
    model, _ = bloom_lm.learn(docs, max_bits=max_bits)
    keys, want = bloom_lm.word_hashes(list(words)), bloom_lm.level_of(np.array(list(words.values())))
    got = model.filter.levels(keys)
    rest = {} if model.rest is None else {r.key % 2**64: r.n for r in model.rest.collect()}
    assert all(g >= w if w >= model.least_word and int(k) not in rest else rest[int(k)] == n for k, g, w, n in zip(keys, got, want, words.values()))


@pytest.mark.parametrize("max_bits", [2**14, 2**17, 2**20, 2**22])
def test_model_scores_do_not_depend_on_the_room(spark, docs, max_bits):
    rows = [(r.text or "") for r in docs.select("text").collect()]
    words, pairs = counts_of(rows)
    value, end, total = bloom_lm.count_of_level(), bloom_lm.word_hashes([b" "])[0], sum(words.values()) + len(words) + 1
    by_hash = dict(zip(bloom_lm.word_hashes(list(words)).tolist(), words.values()))
    stands_for = lambda n: value[bloom_lm.level_of(np.array([n]))[0]]
    want = []
    for t in rows:
        h = bloom_lm.word_hashes(re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()) + [b" "])
        n = [stands_for(by_hash[x]) for x in [int(end), *h.tolist()]]
        both = [stands_for(pairs[k]) for k in bloom_lm.pair_keys(h, end).tolist()]
        want.append(sum(math.log10((min(b, w, p) + 200 * (w + 1) / total) / (p + 200)) for b, w, p in zip(both, n[1:], n)))
    model, rare = bloom_lm.learn(docs, max_bits=max_bits)
    assert len(model.filter.data) <= max_bits // 8 + 2**17
    numbered = spark.createDataFrame(list(enumerate(rows)), "id long, text string")
    got = [r.score for r in bloom_lm.score(numbered, model, rare, keep=["id"]).orderBy("id").collect()]
    assert np.allclose(got, want, rtol=0.02)
    assert sum(got) == pytest.approx(sum(want), rel=0.003)


def test_nothing_is_left_out_where_all_fits(spark):
    # Frequent pairs alone are in the sample of keys; the rare ones are many fewer than there is room for.
    end, rows = bloom_lm.word_hashes([b" "])[0], []
    for i in range(2000):
        h = bloom_lm.word_hashes([f"f{i}".encode(), b" "])
        if (bloom_lm.pair_keys(h, end)[1:] % np.uint64(bloom_lm._SAMPLE) == 0).any():
            rows += [f"f{i}"] * 50
    rows += ["seldom seen words", "once only"]
    words, pairs = counts_of(rows)
    assert rows[0] != "seldom seen words" and len(pairs) < 100
    model, _ = bloom_lm.learn(spark.createDataFrame([(t,) for t in rows], "text string"))
    for keys, n in ((bloom_lm.word_hashes(list(words)), words.values()), (np.array(list(pairs), np.uint64), pairs.values())):
        assert (model.filter.levels(keys) >= bloom_lm.level_of(np.array(list(n)))).all()


def test_scores_without_training_texts(spark, docs, nothing):
    model, rare = bloom_lm.learn(nothing)
    got = bloom_lm.score(docs, model, rare, keep=["doc_id"])
    assert got.count() == docs.count() and got.where("n_known <> 0 or train_tokens <> 0 or base_score <> 0").isEmpty()
    assert bloom_lm.score(nothing, model, rare, keep=["doc_id"]).collect() == []


def test_kneser_ney_is_a_distribution():
    s = language_id.symbols("the cat sat on the mat and the dog sat on the log")
    keys, n = np.unique(language_id.grams(s), return_counts=True)
    m = language_id.kneser_ney(keys, n)
    for context in (s[3:6], s[:3], language_id.symbols("zzz")[3:6]):
        base = np.uint64(0)
        for c in context:
            base = base << np.uint64(16) | c
        every = base << np.uint64(16) | np.arange(65536, dtype=np.uint64)
        assert np.exp(m.log_prob(every)).sum() == pytest.approx(1, abs=1e-6)


def test_distinct_keys_by_table_and_by_sorting():
    rng = np.random.default_rng(2)
    for top in (40, 60_000):
        s = rng.integers(33, 33 + top, 5000).astype(np.uint64)
        keys = language_id.grams(s)
        found, back = language_id._distinct(keys)
        assert (found[back] == keys).all() and sorted(found.tolist()) == np.unique(keys).tolist()


def test_languages_of_held_out_rows(spark):
    got = queries.op9_language_id(spark, SF01).join(queries.table(spark, SF01, "documents").select("doc_id", "lang"), "doc_id")
    right, n = got.where("held_out").agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / n > 0.97 and got.count() == 1000 and got.where("score < 0 or score > 1").isEmpty()


@pytest.mark.parametrize("copies, sample", [(1, 4000), (300, 4000), (300, 40)])
def test_languages_with_few_labels_or_one_id_are_learnt(spark, copies, sample):
    # Ids of the fifth that calibrates, and the greatest spot of many, which a draw leaves out.
    spots = spark.range(10_000).select("id", F.pmod(F.xxhash64("id"), F.lit(1_000_000)).alias("spot")).where("spot % 5 = 0").orderBy("spot").collect()
    greek = [(spots[-1].id, f"λόγος τοῦ ἀνθρώπου ἐν ἀρχῇ {i}", "el") for i in range(copies)]
    latin = [(i, f"the quick brown fox jumps over the lazy dog {i}", "en") for i in range(100)]
    model = language_id.learn(spark.createDataFrame(greek + latin, "doc_id long, text string, lang string"), sample=sample)
    assert model.languages == ["el", "en"] and model.limits[0] == float("inf") and model.limits[1] < float("inf")
    got = language_id.with_language(spark.createDataFrame([("ἐν ἀρχῇ τοῦ λόγος",)], "text string"), model).first()
    assert got.lang_pred == "el" and got.accepted


def test_undetermined_texts_and_rejection(spark, docs, nothing):
    model = language_id.learn(queries.table(spark, SF01, "documents"))
    odd = spark.createDataFrame([(0, None), (1, ""), (2, "123 !?"), (3, "\x00"), (4, "Ω λόγος τοῦ ἀνθρώπου"), (5, "a"), (6, "𝒜𝒷𝒸")], "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.with_language(odd, model).collect()}
    assert [got[i].lang_pred for i in range(4)] == ["und"] * 4 and got[0].score == 0
    assert got[4].lang_pred in model.languages and not got[4].accepted
    assert language_id.with_language(docs, model, keep=["doc_id", "score"]).count() == docs.count()
    none = language_id.learn(nothing)
    assert language_id.with_language(docs, none, keep=["doc_id"]).where("lang_pred <> 'und' or score <> 0").isEmpty()


def plain_scan(text):
    """All parts against all templates, nothing pruned."""
    best, marked = None, set()
    grams = lambda t: licenses.bigrams(t)
    lines = text.split("\n")
    parts = [(p, i, i + 1) for i, line in enumerate(lines) for p in [*licenses._SENTENCE.split(line), line]]
    at = 0
    for block in licenses._BLANK.split(text):
        n = block.count("\n") + 1
        parts.append((block, at, at + n))
        at += n + 1
    parts.append((text, 0, len(lines)))
    for part, first, last in parts:
        a = grams(part)
        for name, template in licenses.TEMPLATES:
            b = grams(template)
            dice = 2 * len(a & b) / (len(a) + len(b))
            if dice >= licenses.LEAST_DICE:
                marked.update(range(first, last))
                best = min(best or (1, ""), (-dice, name))
    return (best[1], round(-best[0], 9), len(marked)) if best else (None, 0.0, 0)


def test_scan_agrees_with_the_plain_one(spark, texts):
    mit = dict((n, t) for n, t in licenses.TEMPLATES if t.startswith("Permission"))["MIT"]
    more = ["Released under the MIT license!", "x y z\nAll rights reserved.\nfoo", "Licensed under CC BY-NC 4.0. And more words here.",
            mit, "head\n\n" + mit.replace("copy,", "copy,\n").replace("merge", "\nmerge") + "\n\ntail of it", "This work is licensed under the GNU General Public "
            "License, version 2.\nAll rights reserved.", "all", "licensed under the", ("word " * 50 + "\n") * 3 + "Licensed under the Apache License, Version 2.0."]
    scanner = licenses.Scanner()
    for t in [t for t in texts if t and len(t) < 10_000] + more:
        assert scanner.scan(t) == plain_scan(t)
    assert scanner.scan(mit)[0] == "MIT" and scanner.scan(more[4])[0] == "MIT" and scanner.scan(more[5])[0] in ("GPL-2.0", "all-rights-reserved")


@pytest.mark.parametrize("mark", ["", " * ", "# ", "// ", "-- "])
@pytest.mark.parametrize("name, width", [(n, w) for n in ("GPL-3.0", "GPL-2.0", "LGPL-3.0", "AGPL-3.0", "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0")
                                         for w in (30, 72)])
def test_wrapped_headers(mark, name, width):
    notice = max((t for n, t in licenses.TEMPLATES if n == name), key=len)
    lines = [mark + line for line in textwrap.wrap(notice, width)]
    head = [mark + "Copyright (C) 2019 some one <a@b.c>", mark.rstrip(), mark + "part of a tool that reads numbers"]
    tail = [mark + "and it goes on here with other words.", "import os", "x = 1", "", "def f(x):", "    return x + 1"]
    got = licenses.Scanner().scan("\n".join(head + lines + tail))
    assert got[:2] == (name, 1.0) and got[2] >= len(lines)


def test_bodies_and_near_licences():
    scan = licenses.Scanner().scan
    met = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are\nmet:\n"
           "1. Redistributions of source code must retain the above copyright\nnotice, this list of conditions and the following disclaimer.\n"
           "2. Redistributions in binary form must reproduce the above copyright\nnotice, this list of conditions and the following disclaimer in the\n"
           "documentation and/or other materials provided with the distribution.\n")
    third = ("3. Neither the name of the copyright holder nor the names of its\ncontributors may be used to endorse or promote products derived from\n"
             "this software without specific prior written permission.\n")
    end = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS\n"AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.'
    assert scan(met + end)[:2] == ("BSD-2-Clause", 1.0) and scan(met + third + end)[:2] == ("BSD-3-Clause", 1.0)
    assert scan('1.1. "Contributor"\n    means each individual or legal entity that creates, contributes to\n    the creation of, or owns Covered Software.\n\n'
                '1.2. "Contributor Version"\n    means the combination of the Contributions of others')[:2] == ("MPL-2.0", 1.0)
    assert scan("x\n\nBy exercising the Licensed Rights (defined below), You accept and agree to\nbe bound by the terms and conditions of this Creative Commons\n"
                "Attribution-ShareAlike 4.0 International Public License (\"Public License\"). To the\nextent this Public License may be interpreted as a contract")[:2] == (
                    "CC-BY-SA-4.0", 1.0)
    assert scan("This tool and all of its parts are released under the MIT License, see there, by the people who wrote it.") == ("MIT", 1.0, 1)
    assert scan("we licensed\nmany things under\nthe sun and all\nrights to them") == (None, 0.0, 0)


def test_scan_of_odd_tables(spark, docs, nothing):
    got = licenses.scan_licenses(docs)
    assert got.count() == docs.count() and got.where("text is null and (license is not null or dice <> 0)").isEmpty()
    assert licenses.scan_licenses(nothing).collect() == []


@pytest.mark.parametrize("name,notice", [
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n"
                 " * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "# This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
                 "as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0-only", "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License version 2 as\n"
                     "published by the Free Software Foundation."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\n"
             "freely, subject to the following restrictions:"),
    ("BSL-1.0", "// Distributed under the Boost Software License, Version 1.0.\n// (See accompanying file LICENSE_1_0.txt)"),
    ("EPL-2.0", "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\n"
                "which is available at https://www.eclipse.org/legal/epl-2.0/"),
])
def test_usual_notices_and_their_versions(name, notice):
    text = "some words before it\n" + notice + "\nint main() { return 0; }"
    assert licenses.Scanner().scan(text)[0] == name


def plain_kneser_ney(texts):
    """Interpolated Kneser-Ney by dictionaries: a function from four symbols to the log probability of the last one."""
    counts = [Counter(tuple(s[i:i + 4].tolist()) for s in texts for i in range(len(s) - 3))]
    for _ in range(3):
        counts.append(Counter(g[1:] for g in counts[-1]))
    discounts = []
    for c in counts:
        ones, twos = sum(n == 1 for n in c.values()), sum(n == 2 for n in c.values())
        discounts.append(min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5)
    totals, kinds = [Counter() for _ in counts], [Counter() for _ in counts]
    for k, c in enumerate(counts):
        for g, n in c.items():
            totals[k][g[:-1]] += n
            kinds[k][g[:-1]] += 1

    def prob(g, k):
        below = prob(g[1:], k + 1) if k < 3 else 1 / 65536
        total = totals[k][g[:-1]]
        return (max(counts[k][g] - discounts[k], 0) + discounts[k] * kinds[k][g[:-1]] * below) / total if total else below

    return lambda g: math.log(prob(tuple(g), 0))


def test_language_models_equal_plain_kneser_ney():
    rng = np.random.default_rng(6)
    words = {k: ["".join(rng.choice(list(a), rng.integers(2, 6))) for _ in range(30)] for k, a in (("x", "abcde"), ("y", "bdefg"), ("z", "aeiou"))}
    make = lambda k, n: " ".join(rng.choice(words[k], n))
    learnt = {k: [language_id.symbols(make(k, 20)) for _ in range(15)] for k in words}
    plain, fast = {}, []
    for k, texts_ in learnt.items():
        plain[k] = plain_kneser_ney(texts_)
        fast.append(language_id.kneser_ney(*np.unique(np.concatenate([language_id.grams(t) for t in texts_]), return_counts=True)))
    model = language_id.Model(list(words), fast)
    tests = [make(k, n) for k in words for n in (1, 3, 12)] + ["zzz qqq", "Ab. CD! é", "aeg"]
    for text in tests:
        s = language_id.symbols(text)
        found = {k: -np.mean([f(s[i:i + 4].tolist()) for i in range(len(s) - 3)]) for k, f in plain.items()}
        assert model.entropies([s])[0] == pytest.approx([found[k] for k in words], rel=1e-12)
        assert model.predict([text])[0] == [min(found, key=lambda k: (round(found[k], 12), k))]


def test_known_grams_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(language_id, "_CACHE", 2000)
    texts_ = [language_id.symbols(t) for t in ("abc abd abe", "xyz xyw xyv")]
    model = language_id.Model(["a", "b"], [language_id.kneser_ney(*np.unique(language_id.grams(t), return_counts=True)) for t in texts_])
    once = [model.predict([t])[0] for t in ("abc", "xyz")]
    for k in range(60):
        model.predict(["".join(chr(97 + (k * j) % 26) for j in range(1, 12))])
        assert model._known.nbytes + model._values.nbytes < 2000 + 24 * 12
    assert [model.predict([t])[0] for t in ("abc", "xyz")] == once
