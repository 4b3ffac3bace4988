"""Quality rules, license scans and toxicity."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from shoptrail.llm import licenses, quality, toxicity
from tests.llm.fixtures import alnum, documents, odd_rows, prose, spaced, text

FOLDER = "/root/testdata/sf0.01"


def counts(t):
    ws, found = spaced(t), t or ""
    at = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    covered = {j for i in range(len(ws) - 2) if at[tuple(ws[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in found.split("\n"):
        if spaced(line):
            dup += line in seen
            seen.add(line)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in found), dup, len(covered)


def more_rows():
    return odd_rows() + [(30, "a\na\n a\nb #*$%&|<>\n\nb\na"), (31, "x y z x y z x y"), (32, text(1, 400)), (33, "漢 字 漢 字 漢 字\n\n漢 字")]


def test_statistics(spark):
    rows = more_rows()
    got = sorted((tuple(r) for r in quality.statistics(documents(spark, rows)).select("doc_id", *quality.COUNTS[:5], "base_failed").collect()), key=str)
    want = sorted(((i, *(c := counts(t)), c[0] < 50 or 100 * c[4] > 50 * c[0]) for i, t in rows), key=str)
    assert got == want
    assert quality.statistics(documents(spark, [])).collect() == []


def test_rules_learned_and_applied(spark):
    good = [(k, text(k, 80)) for k in range(200)]
    bad = [(300 + k, " ".join(w + "###" for w in prose(k, 80))) for k in range(60)]
    docs = documents(spark, good + bad + odd_rows()[:3])
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good[:150]] + [(i, 0, 0) for i, _ in bad[:40]] + [(None, 0, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    judged = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    assert all(judged[i].kept for i, _ in good if i > 5) and not any(judged[i].kept for i, _ in bad)
    assert all(judged[i].rule for i, _ in bad)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in judged.items() if r.kept}
    none = quality.judge(docs, labels.limit(0))
    assert none.filter("kept = base_failed").count() == 0


def test_quality_keeps_columns_of_any_name(spark):
    good, bad = [(k, text(k, 80)) for k in range(150)], [(300 + k, " ".join(w + "###" for w in prose(k, 80))) for k in range(60)]
    docs = documents(spark, good + bad).selectExpr("*", "'mine' as n_words", "'no' as base_failed", "3 as _rule", "4 as doc", "5 as n_lines", "6 as known", "7 as rule", "8 as kept")
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i, _ in good + bad], "doc_id long, quality int, toxic int")
    kept = quality.keep_good(docs, labels)
    assert kept.schema == docs.schema
    rows = kept.collect()
    assert {r.doc_id for r in rows} == {i for i, _ in good}
    assert {(r.n_words, r.base_failed, r._rule, r.doc, r.n_lines, r.known, r.rule, r.kept) for r in rows} == {("mine", "no", 3, 4, 5, 6, 7, 8)}
    assert {r.doc_id for r in quality.judge(docs, labels).filter("kept").collect()} == {i for i, _ in good}


def test_few_labelled_rows_are_ordered_and_fetched(spark, monkeypatch):
    """The fitting rows are the ones of the smallest hashes, and only little more than are wanted are sorted."""
    rows = [(k, text(k, 60) if k % 3 else " ".join(w + "##" for w in prose(k, 60))) for k in range(600)]
    stats = quality.statistics(documents(spark, rows + rows[:100]))
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    taken = []
    monkeypatch.setattr(quality, "learn", lambda x, bad, prune: taken.append((len(bad), int(bad.sum()))) or [])
    for _ in range(2):
        quality.fit(stats, labels, most_rows=90)
    quality.fit(stats, labels)
    assert taken[0] == taken[1] and taken[0][0] <= 90 and taken[0][0] > 60 and taken[2] == (600, 200)


def test_rules_are_conjunctions_in_order():
    rng = np.random.default_rng(1)
    x = {"symbols_a_word": rng.random(3000), "upper_share": rng.random(3000)}
    bad = ((x["symbols_a_word"] > 0.7) & (x["upper_share"] > 0.6)) | (x["upper_share"] < 0.05)
    rules = quality.learn(x, bad, np.arange(3000) % 3 == 0)
    hit = np.zeros(3000, bool)
    for rule in rules:
        hit |= quality._fits(rule, x, 3000)
    assert (hit & bad).sum() > 0.9 * bad.sum() and (hit & ~bad).sum() < 0.02 * hit.sum()


# -- licences

PHRASES = {("gnu", "general", "public", "license"): "gpl", ("apache", "license"): "apache", ("cc", "by"): "cc-by", ("mit", "license"): "mit"}


def base(t):
    ws = alnum(t)
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(ws)) if tuple(ws[i:i + len(phrase)]) == phrase]
    at = [i for i, _ in places]
    return len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


LEGAL = [
    "Released under the MIT License.", "submit license mit-license MIT\nLICENSE MIT License MIT License", "Licensed under CC BY-NC 4.0.", "ccc by cc_by cc bye cc.by",
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0.",
    "SPDX-License-Identifier: GPL-2.0-or-later", "see https://www.apache.org/licenses/LICENSE-2.0", "All rights reserved. é MIT é License", "mit der Zeit", "Émit license",
]


def test_base_phrases(spark):
    rows = odd_rows() + [(100 + k, t) for k, t in enumerate(LEGAL)] + [(200, text(1, 3000) + " MIT License " + text(2, 9))]
    got = licenses.scan(documents(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) == sorted(((i, *base(t)) for i, t in rows), key=str)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(r.labels.split(","))))
    assert licenses.scan(documents(spark, [])).collect() == []


def test_signatures_resolve_overlaps():
    scan = licenses.Scanner()
    assert len(scan.rules) > 200
    labels = lambda t: [d[2] for d in scan.detections(t.lower().encode())]
    assert labels(LEGAL[2]) == ["cc-by-nc-4.0"]
    assert labels(LEGAL[4]) == ["gpl-3.0"]
    assert labels(LEGAL[5]) == ["apache-2.0"]
    assert labels(LEGAL[6]) == ["gpl-2.0"]
    assert labels(LEGAL[7]) == ["apache"]
    assert labels("Dual: BSD 3-Clause License or GNU Lesser General Public License v2.1") == ["bsd-3-clause", "lgpl-2.1"]
    assert labels(LEGAL[9]) == [] and labels("") == []


NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy\n * of this software and associated documentation files (the \"Software\"), to deal"),
    ("bsd", "Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions are met:"),
    ("bsd-3-clause", "Neither the name of the University nor the names of its contributors may be used to endorse or promote products\nderived from this software without specific"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that"),
    ("zlib", "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable for any damages"),
    ("zlib", "2. Altered source versions must be plainly marked as such, and must not be\n   misrepresented as being the original software."),
    ("apache", "you may not use this file except in compliance with the License.\nYou may obtain a copy"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("gpl-3.0", "under the terms of the GNU General Public License as published by\n// the Free Software Foundation, either version 3 of the License, or"),
    ("lgpl-2.1", "the GNU Lesser General Public\n * License as published by the Free Software Foundation; either\n * version 2.1 of the License"),
    ("gpl-2.0", "the GNU General Public License as published by the Free Software Foundation; version 2."),
]


def test_licences_by_their_own_words():
    scan = licenses.Scanner()
    for label, notice in NOTICES:
        assert [d[2] for d in scan.detections(notice.lower().encode())] == [label], notice
    for label, words, key, _ in licenses.BODIES:
        plain = words.replace("[sc]", "c").replace("(?:/or)?", "").replace("(?:s|d)?", "").replace("(?:s)?", "").replace("s?", "s").replace("e?", "e")
        if key in plain:
            assert label in {d[2] for d in scan.detections(plain.encode())}, label


# -- toxicity


def test_held_out_rows_and_defined_cases(spark):
    rows = odd_rows() + odd_rows()[3:4]
    labels = spark.createDataFrame([(3, 1, 1), (4, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.judge(documents(spark, rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert toxicity.judge(documents(spark, []), labels).collect() == []
    assert {r.score for r in toxicity.judge(documents(spark, rows), labels.limit(0)).collect()} == {0.0}


def test_held_out_accuracy(spark):
    def doc(k):
        words = prose(k, 60) + ["the", "of"] * 5
        return " ".join(words[:30] + (["idiot", "Moron!", "trash"][k % 3:] if k % 8 == 0 else []) + words[30:])

    rows = [(k, doc(k)) for k in range(1600)]
    labels = spark.createDataFrame([(k, 1, int(k % 8 == 0)) for k in range(0, 1600)], "doc_id long, quality int, toxic int")
    held = [r for r in toxicity.judge(documents(spark, rows), labels).collect() if r.held_out]
    hit = sum(r.predicted == (r.doc_id % 8 == 0) for r in held)
    assert len(held) > 300 and hit >= 0.97 * len(held)


def test_held_out_labels_do_not_count(spark):
    rows = [(k, text(k, 30) + (" idiot" if k % 5 == 0 else "")) for k in range(400)]
    held = lambda k: zlib.crc32(str(k).encode()) % 4 == 2
    one = spark.createDataFrame([(k, 1, int(k % 5 == 0)) for k in range(400)], "doc_id long, quality int, toxic int")
    two = spark.createDataFrame([(k, 1, int(k % 5 != 0) if held(k) else int(k % 5 == 0)) for k in range(400)], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows)
    assert sorted(toxicity.judge(docs, one).collect()) == sorted(toxicity.judge(docs, two).collect())


def test_scores_of_no_words():
    model = toxicity.Model(np.array([5], np.uint64), np.array([2.0]), -1.0)
    assert model.scores(pa.array([None, "", "x"])).tolist() == [1 / (1 + np.exp(1.0))] * 3


def test_contained_detections_are_left_out_as_by_comparing_all():
    """Many notices in one text: the same spans as by comparing each with all, in time that follows their number."""
    import time

    scanner = licenses.Scanner()

    def plain(low):
        gated = sorted({i for key, rules in scanner.by_keyword.items() if key in low for i in rules})
        found = sorted((-scanner.rules[i].priority, m.start() - m.end(), m.start(), i, m.end()) for i in gated for m in scanner.rules[i].pattern.finditer(low))
        accepted = []
        for _, _, a, i, b in found:
            if not any(x <= a and b <= y for x, y, _, _ in accepted):
                accepted.append((a, b, scanner.rules[i].label, scanner.rules[i].confidence))
        return sorted(accepted)

    notice = b"licensed under the apache license version 2.0, see www.apache.org/licenses/license-2.0. spdx-license-identifier: mit\n gnu general public license version 3 \n"
    assert scanner.detections(notice * 40) == plain(notice * 40)
    spent = []
    for n in (2_000, 8_000):
        start = time.process_time()
        assert len(scanner.detections(notice * n)) >= 3 * n
        spent.append(time.process_time() - start)
    assert spent[1] < 8 * spent[0]
