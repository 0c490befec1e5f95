"""Line dedup, pieces, URLs, tool calls and licences on small rows."""

import math
from collections import Counter, defaultdict
from datetime import date

import numpy as np
import pytest
import pyarrow as pa

from wattloom.llm import lines as line_parts
from wattloom.llm import linking, pieces
from wattloom.llm.chat import depths, link_tool_calls
from wattloom.llm.licenses import scan_licenses
from wattloom.llm.lines import block_keys, edit_distance, line_dedup
from wattloom.llm.urls import url_filter

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def test_edit_distance():
    assert edit_distance(b"kitten", b"sitting", 3) == 3 and edit_distance(b"kitten", b"sitting", 2) is None
    assert edit_distance("é x".encode(), "e x".encode(), 5) == 1 and edit_distance(b"", b"", 0) == 0


def test_close_hashes_share_a_key():
    g = np.random.default_rng(0)
    h = g.integers(0, 2 ** 63, 500).astype(np.uint64)
    other = h.copy()
    for _ in range(3):
        other ^= np.uint64(1) << g.integers(0, 64, 500).astype(np.uint64)
    assert (block_keys(h, 3) == block_keys(other, 3)).any(axis=1).all()


def test_lines(spark):
    line = "The quick brown fox jumps over the lazy dog while many other words follow it down the road"
    rows = [(3, f"{line}\nonly here"), (1, f"first\n{line.upper()}!"), (2, None), (4, ""), (5, "\n\n"), (None, line), (7, line), (7, line),
            (8, "order 12 of 55\norder 99 of 10")]
    out = line_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(((r.doc_id, r.text, r.n_lines_removed) for r in out.collect()), key=str)
    assert got == sorted([(3, "only here", 1), (1, rows[1][1], 0), (2, None, 0), (4, "", 0), (5, "\n\n", 0), (None, line, 0), (7, "", 1), (7, "", 1),
                          (8, "order 12 of 55", 1)], key=str)


def test_lines_with_a_changed_word_or_letter_go(spark):
    import random

    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8)))
    rows = [(1000, "abcdefghij"), (1001, "abcxefghij"), (1002, "bcdefghijk"), (1003, "qrstu"), (1004, "qrst"), (1005, "completely other words")]
    for i in range(120):
        line = [word() for _ in range((8, 15, 27)[i % 3])]
        rows.append((2 * i, " ".join(line)))
        line[len(line) // 2] = word() if i % 2 else line[len(line) // 2][:-1] + "z"
        rows.append((2 * i + 1, " ".join(line)))
    got = {r.doc_id: r.n_lines_removed for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    near = [a for (a, x), (b, y) in zip(rows[7::2], rows[6::2]) if edit_distance(x.encode(), y.encode(), max(len(x), len(y)) // 5) is not None]
    assert len(near) > 100 and sum(got[a] for a in near) >= 0.97 * len(near) and not any(got[2 * i] for i in range(120))
    assert [got[i] for i in range(1000, 1006)] == [0, 1, 1, 0, 1, 0]


def _sample(texts, k):
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    return [r for b in pieces._encode(MODEL, k, 1.0, 0)(iter([batch])) for r in b.to_pylist()]


def test_pieces_round_trip_and_are_distinct():
    vocab = pieces.vocabulary(MODEL)
    texts = ["", None, "a", "Hello  world\n\tñ ☃ 漢字 end ", " x" * 50]
    by = defaultdict(list)
    for r in _sample(texts, 3):
        by[r["doc_id"]].append(r["piece_ids"])
        assert r["piece_ids"] == b"" or pieces.decode_ids(np.frombuffer(r["piece_ids"], "<i4"), vocab) == texts[r["doc_id"]]
    assert all(len(set(v)) == len(v) for v in by.values()) and len(by[3]) == 3 and len(by[0]) == len(by[1]) == 1


def test_inclusion_scores_are_unbiased():
    n, weight, first = 4000, Counter(), Counter()
    for r in _sample(["the"] * n, 1):
        weight[r["piece_ids"]] += math.exp(-r["log_inclusion"]) * math.exp(r["log_prob"])
        first[r["piece_ids"]] += math.exp(r["log_prob"]) * 0 + 1
    top, count = first.most_common(1)[0]
    p = next(math.exp(r["log_prob"]) for r in _sample(["the"] * 50, 1) if r["piece_ids"] == top)
    assert abs(count / n - p) < 0.02 and abs(weight[top] / n / p - 1) < 0.05


def test_lines_of_two_texts_under_one_id_and_clashing_columns(spark):
    rows = [(1, "a line that is here more than once\nand one of its own"), (2, "first text has a line of its own\na line that is here more than once\nsecond alone"),
            (2, "second text under the id that is taken\nthis one is found nowhere else at all\nlast words"), (None, "a line that is here more than once"), (3, None), (4, "")]
    names = ["__gone", "__id", "gone", "row", "line", "place", "text_hash", "keys", "n_lines_removed"]
    df = spark.createDataFrame([(d, t, *["x"] * len(names)) for d, t in rows], "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    out = line_dedup(df)
    assert out.columns == [*df.columns[:-1], "n_lines_removed"] and dict(out.dtypes)["n_lines_removed"] == "bigint"
    want = [(d, "first text has a line of its own\nsecond alone" if t and t.startswith("first") else t, int(bool(t and t.startswith("first")))) for d, t in rows]
    assert sorted(((r.doc_id, r.text, r.n_lines_removed) for r in out.collect()), key=str) == sorted(want, key=str)
    assert line_dedup(df.limit(0)).collect() == []


def test_keys_of_a_line_alone_are_never_written(spark, monkeypatch):
    written = []

    materialize = linking.materialize

    def told(df):
        written.append(materialize(df))
        return written[-1]

    for module in (line_parts, linking):
        monkeypatch.setattr(module, "materialize", told)
        monkeypatch.setattr(module, "discard", lambda *frames: None)
    rows = [(i, chr(65 + i) * 30) for i in range(20)] + [(30, "quite another line of this table"), (31, "quite another line of this tables")]
    got = {r.doc_id: r.n_lines_removed for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [i for i, n in got.items() if n] == [31]
    assert all("keys" not in df.columns for df in written)
    assert {df.select("id").distinct().count() for df in written if "key" in df.columns} <= {0, 2}


def test_documents_are_shuffled_for_their_lines_once(spark, monkeypatch):
    calls, pick = [], line_parts._pick
    monkeypatch.setattr(line_parts, "_pick", lambda: calls.append(1) or pick())
    rows = [(i, f"a line that differs by its {c * 2} only, in the middle of it\n{c * 30}") for i, c in enumerate("abc")]
    got = {r.doc_id: r.n_lines_removed for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 1, 2: 1} and len(calls) == 1


def test_few_texts_are_held_as_python_objects_at_a_time():
    texts = [f"one line {i}\nand two" for i in range(1000)]
    batch = pa.record_batch([pa.array(range(1000), pa.int64()), pa.array(range(1000), pa.int64()), pa.array(texts)], ["doc_id", "text_hash", "text"])
    out = list(line_parts._lines()([batch]))
    assert sum(x.num_rows for x in out) == 2000 and max(x.num_rows for x in out) <= 500
    assert [x for y in out for x in y.column("doc_id").to_pylist()] == [i for i in range(1000) for _ in range(2)]
    wanted = pa.array([[{"line": 1, "id": i}] for i in range(1000)])
    out = list(line_parts._pick()([batch.append_column("wanted", wanted)]))
    assert max(x.num_rows for x in out) <= 250 and [x for y in out for x in y.column("id").to_pylist()] == list(range(1000))


def test_many_pairs_are_compared_in_portions(spark, monkeypatch):
    rows = [(i, f"a line that differs by its {c * 2} only, in the middle of it") for i, c in enumerate("abcdefgh")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(line_dedup(docs).collect())
    monkeypatch.setattr(line_parts, "_PAIRS", 0.25)
    assert sorted(line_dedup(docs).collect()) == want
    assert [r.n_lines_removed for r in want] == [0] + [1] * 7


def test_one_very_long_line_and_equal_lines(spark):
    long = "word and other words " * 40_000
    rows = [(7, long), (5, long), (6, "tie of a line\ntie of a line\nTIE of a line!")]
    got = {r.doc_id: (r.text, r.n_lines_removed) for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {5: (long, 0), 7: ("", 1), 6: ("tie of a line", 2)}


def _ways(lattice):
    """Every segmentation of the lattice's one word, with its probability."""
    out = {}

    def go(node, path, log_p):
        if lattice.final[node]:
            out[tuple(path)] = math.exp(log_p)
        else:
            for e in np.flatnonzero(lattice.src == node).tolist():
                go(lattice.dst[e], [*path, e], log_p + math.log(lattice.p[e]))
    go(int(lattice.start[0]), [], 0.0)
    return out


def _drawn(lattice, seeds, k):
    m = len(seeds)
    paths, _, scores = pieces._sampled(lattice, np.arange(m), np.zeros(m, np.int64), seeds, k)
    return [[tuple(edges[begin[i]:begin[i] + size[i]].tolist()) for j, (_, edges, _, begin, size) in enumerate(paths) if np.isfinite(scores[i, j])]
            for i in range(m)]


def test_no_segmentation_is_left_out():
    vocab = pieces.vocabulary(MODEL)
    for word, count in (("the", 8), ("nation", 49), ("xz", 2)):
        lattice = pieces.Lattice([pieces.SPACE + word], vocab, 1.0)
        ways = _ways(lattice)
        assert len(ways) == count and abs(sum(ways.values()) - 1) < 1e-9
        for k in {1, 2, count // 2 + 1, count, count + 3}:
            for got in _drawn(lattice, np.arange(1, 13, dtype=np.uint64) * np.uint64(7919), k):
                assert len(set(got)) == len(got) == min(k, count) and set(got) <= set(ways)


def test_first_and_second_samples_have_their_frequencies():
    vocab, m = pieces.vocabulary(MODEL), 30_000
    lattice = pieces.Lattice([pieces.SPACE + "nation"], vocab, 1.0)
    p = _ways(lattice)
    got = _drawn(lattice, (np.arange(m, dtype=np.uint64) + np.uint64(5)) * np.uint64(0x9E3779B97F4A7C15), 2)
    for j, want in enumerate((p, {b: sum(p[a] * p[b] / (1 - p[a]) for a in p if a != b) for b in p})):
        seen = Counter(g[j] for g in got)
        assert max(abs(seen[w] / m - want[w]) for w in p) < 0.012


def test_urls(spark):
    d = date
    captures = [(1, "http://a.b.com/x/y", d(2024, 1, 5)), (2, "https://u@B.com.:80/x?q", d(2024, 1, 1)), (3, "http://a.b.com/x", d(2024, 2, 1)),
                (4, None, d(2024, 1, 1)), (5, "nothing", d(2024, 1, 1)), (6, "http://a.b.com", None), (1, "http://a.b.com/x/y", d(2024, 1, 5))]
    entries = [("l", "b.com", d(2024, 1, 2), True), ("l", "b.com", d(2024, 1, 20), False), ("m", "a.b.com/x", d(2023, 1, 1), True), ("l", None, d(2024, 1, 1), True)]
    out = url_filter(spark.createDataFrame(captures, "capture_id long, url string, fetched_at date"),
                     spark.createDataFrame(entries, "list string, pattern string, listed_at date, active boolean"))
    got = Counter((r.capture_id, r.n_matches, r.lists, r.blocked) for r in out.collect())
    assert got == Counter({(1, 2, "l,m", True): 2, (2, 0, "", False): 1, (3, 1, "m", True): 1, (4, 0, "", False): 1, (5, 0, "", False): 1, (6, 0, "", False): 1})


def test_tool_calls(spark):
    call = lambda i, needs, args, name="lookup", conv=1: (conv, 0, "call", i, name, args, needs, None)
    good = {"key": '"a"', "exact": "true"}
    rows = [call("c", ["a", "b"], good), call("a", [], good), call("b", ["a", "gone"], {"key": "1", "more": "2"}), call("x", ["y"], good), call("y", ["x"], good),
            call("n", None, None, None), (1, 1, "result", "a", None, None, None, 'say "hi"\n\x01'), (1, 1, "result", "orphan", None, None, None, "r"),
            (None, 0, "call", "z", "lookup", good, [], None)]
    out = link_tool_calls(spark.createDataFrame(rows, "conv_id long, turn int, kind string, call_id string, name string, arguments map<string,string>, "
                                                "needs array<string>, content string"))
    got = {r.call_id: r for r in out.collect()}
    assert [got[i].depth for i in "abcxyn"] == [0, 1, 2, None, None, 0]
    assert [got[i].status for i in ("a", "b", "x", "orphan")] == ["linked", "unanswered", "cyclic", "orphan"]
    assert got["b"].errors == "missing exact,not string: key,unknown more" and got["n"].errors == "no arguments" and got["a"].valid
    assert got["a"].json == '{"arguments":{"exact":true,"key":"a"},"id":"a","name":"lookup","result":"say \\"hi\\"\\n\\u0001"}'


def _longest(needs: dict) -> dict:
    """Longest chain below each call, None where it may go on without end."""
    known = {i: 0 for i in needs}
    for _ in range(len(needs) + 1):
        known = {i: max((known[j] + 1 for j in needs[i] if j in needs), default=0) for i in needs}
    return {i: None if d >= len(needs) else d for i, d in known.items()}


def _depths(spark, needs: dict, turn=lambda i: 0) -> dict:
    calls = spark.createDataFrame([(1, i, turn(i)) for i in needs], "conv_id long, call_id string, turn int")
    pairs = spark.createDataFrame([(1, i, j) for i, js in needs.items() for j in js], "conv_id long, call_id string, needed string")
    return {r.call_id: r.depth for r in depths(calls, pairs).collect()}


def test_depths_of_tangled_calls(spark):
    """Forks, circles, needs of a call itself, repeats and unknown needs, against rounds of plain relaxation."""
    g = np.random.default_rng(3)
    needs = {}
    for block in range(25):  # even blocks without circles
        n = int(g.integers(1, 14))
        for i in range(n):
            some = g.integers(0, max(i, 1) if block % 2 == 0 else n, int(g.integers(0, 4)))
            needs[f"{block}.{i}"] = [f"{block}.{j}" for j in some if block % 2 or j < i] + ["gone"] * int(g.integers(0, 2))
    expected = _longest(needs)
    assert _depths(spark, needs) == expected and None in expected.values() and max(filter(None, expected.values())) > 4
    assert _depths(spark, needs, turn=lambda i: int(i.split(".")[1])) == expected
    circle = {"u": ["v", "w", "x"], "v": ["x"], "w": ["v"], "x": ["w"], "s": ["s", "e"], "e": [], "t": ["s"]}
    assert _depths(spark, circle) == dict.fromkeys("uvwxst", None) | {"e": 0}


def test_depths_of_one_long_conversation(spark, monkeypatch):
    """Every call needs the two before it: never more rows than calls and needs."""
    from wattloom.llm import chat

    n, rows = 1500, []

    def counted(df, write=chat.materialize):
        out = write(df)
        if "steps" in out.columns:
            rows.append(out.count())
        return out
    monkeypatch.setattr(chat, "materialize", counted)
    needs = {f"c{i}": [f"c{j}" for j in (i - 1, i - 2) if j >= 0] for i in range(n)}
    assert _depths(spark, needs, turn=lambda i: int(i[1:])) == {f"c{i}": i for i in range(n)}
    assert max(rows) <= 2 * n and len(rows) <= 14


def test_arguments_are_written_in_one_form(spark):
    """Invalid JSON never passes as valid or reaches the output; a value has one text; repeats, ties, empty tables."""
    import json

    cases = {"01": None, '"x" , "y"': None, ' { "b" : [ 1 , {"d":2,"c":true} ], "a" : "x" } ': '{"a":"x","b":[1,{"c":true,"d":2}]}', '"\\u0061\\/"': '"a/"',
             '"\\u001f\\n"': '"\\u001f\\n"', "7": "7", " -12 ": "-12", "true": "true", "tru": None, "1]": None, '1,"q":2': None, "[1": None, "1 2": None, '{"a":1,"a":2}': None, "null": "null", "": None,
             '"é\\ud83d\\ude00"': '"é😀"', "1e2": "100.0", "[]": "[]"}
    rows = [(1, i, "call", f"c{i}", "compute", {"expression": '"1"', "digits": v}, [], None) for i, v in enumerate(cases)]
    rows += [rows[5], (1, 0, "call", "c5", "compute", {"digits": "9"}, [], None), (1, 0, "result", "c5", None, None, None, "b"), (1, 0, "result", "c5", None, None, None, "a"),
             (1, 9, "call", "nul", "compute", {"expression": None, "digits": "3"}, None, "x" * 200_000)]
    schema = "conv_id long, turn int, kind string, call_id string, name string, arguments map<string,string>, needs array<string>, content string"
    df = spark.createDataFrame(rows, schema).selectExpr("*", "1 as depth", "'s' as status", "'p' as parsed", "true as called")
    got = {r.call_id: r for r in link_tool_calls(df).collect()}
    for i, (raw, text) in enumerate(cases.items()):
        r = got[f"c{i}"]
        whole = json.loads(r.json)
        assert json.dumps(whole, sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r.json or raw == "1e2"
        if i != 5:
            assert f'"digits":{json.dumps(raw, ensure_ascii=False) if text is None else text},' in r.json, (raw, r.json)
        assert (r.errors == "") == (raw in ("7", " -12 ") and i != 5) and not (r.valid and text is None)
    assert json.loads(got["c5"].json)["result"] == "a" and got["c5"].errors == "missing expression"
    assert got["nul"].errors == "not string: expression"
    assert link_tool_calls(df.limit(0)).collect() == []


def test_licenses(spark):
    rows = [(1, "a/b/f.txt", "code\nnothing here"), (2, "a/LICENSE", "Released under the MIT License."), (3, "a/b/c/g.txt", "x\nLicensed under CC BY-NC 4.0.\ny"),
            (4, "z/f.txt", None), (5, None, "words"), (6, "a/b/f.txt", "")] + [(10 + i, f"q/{i}", "plain words of a text") for i in range(50)]
    got = {r.doc_id: (r.stated, r.license, r.inherited_from) for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert got[1] == got[6] == (None, "MIT", "a") and got[2][:2] == ("MIT", "MIT") and got[3][0] == "CC-BY-NC-4.0"
    assert got[4] == got[5] == got[10] == (None, None, None)


def test_licenses_over_several_lines(spark):
    apache = """# Copyright 2020 Some Body
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
import os"""
    gnu = """/* This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU {}General Public License as published by
 * the Free Software Foundation, either version {} of the License, or
 * (at your option) any later version. */"""
    mpl = "// This Source Code Form is subject to the terms of the Mozilla\n// Public License, v. 2.0. If a copy of the MPL was not\n// distributed with this file, You can obtain one at\n// https://mozilla.org/MPL/2.0/.\n"
    mit = """MIT License

Copyright (c) 2021 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED."""
    bsd = """3. Neither the name of Example Inc nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
    texts = [apache, gnu.format("", 3), gnu.format("", 2), gnu.format("Affero ", 3), mpl, bsd,
             "x = 1  # Copyright (c) 2020 Jane Doe and friends of many names. Released under the MIT License. All rights reserved."]
    rows = [(i, f"s/{i}.txt", t) for i, t in enumerate(texts)] + [(20, "p/COPYING", mit), (21, "p/a.txt", "nothing"), (22, "q/b.txt", "a license to use the software")]
    rows += [(100 + i, f"q/{i}", "the plain words of a text that is under this or that name") for i in range(50)]
    got = {r.doc_id: (r.stated, r.license) for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert [got[i][0] for i in range(7)] == ["Apache-2.0", "GPL-3.0", "GPL-2.0", "AGPL-3.0", "MPL-2.0", "BSD-3-Clause", "MIT"]
    assert got[20] == ("MIT", "MIT") and got[21] == (None, "MIT") and got[22] == got[100] == (None, None)


def test_shared_grams_never_rule_out_a_near_line():
    import random

    from wattloom.llm.lines import edit_distance, may_be_alike

    rng = random.Random(7)
    for _ in range(400):
        x = "".join(rng.choice("abc dé😀") for _ in range(rng.choice([0, 1, 2, 3, 30, 300])))
        y = list(x)
        for _ in range(rng.randint(0, max(1, len(x) // 5))):
            at = rng.randrange(len(y) + 1)
            y[at:at + rng.randint(0, 1)] = rng.choice(["", "z", "ü"])
        y = "".join(y)
        longest = max(len(x), len(y))
        if edit_distance(x.encode(), y.encode(), longest // 5) is not None:
            assert may_be_alike(x.encode(), y.encode(), longest, longest // 5, {})
    assert not may_be_alike(b"a" * 100, b"b" * 100, 100, 20, {})


def test_simhash_is_the_majority_of_word_bits():
    import numpy as np

    from wattloom.llm.common import word_hashes
    from wattloom.llm.lines import simhash

    lines = [b"", b"one", b"one two two", b"x y " * 300 + b"z", b" ".join(b"%d" % i for i in range(600))]
    for line, got in zip(lines, simhash(lines)):
        words = [int(h) for h in word_hashes(line.split())]
        assert int(got) == sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in words) > len(words))
    assert len(simhash([])) == 0 and simhash([b""]) == np.zeros(1)


def test_lines_side_by_side_are_as_far_apart_as_one_by_one():
    g = np.random.default_rng(5)
    letters = [*"abcdefgh \u00e9\u6f22"]
    texts = ["", "a", "\u00e9", "x" * 64, "x" * 65, "y" * 128, "x" * 5000, "x" * 4500 + "y" * 400]
    for size in [3, 9, 20, 63, 64, 65, 100, 127, 130, 200, 400, 700] * 4:
        text = g.choice(letters, size).tolist()
        for share in (0, 0.1, 0.2, 0.25):
            other = list(text)
            for _ in range(int(size * share)):
                i = int(g.integers(len(other)))
                other[i:i + int(g.integers(2))] = g.choice(letters, int(g.integers(2))).tolist()
            texts.append("".join(other))
    lines = [x.encode() for x in texts]
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(lines)), np.arange(len(lines))))
    near = np.abs(a - b) < 12
    a, b = a[near], b[near]
    got = line_parts.Texts(lines).alike(a, b, 80)
    most = [max(len(texts[i]), len(texts[j])) // 5 for i, j in zip(a, b)]
    want = [edit_distance(lines[i], lines[j], d) is not None for i, j, d in zip(a, b, most)]
    assert got.tolist() == want and 0 < sum(want) < len(want)


def test_long_lines_without_enough_grams_in_common_are_not_read(monkeypatch):
    g = np.random.default_rng(8)
    texts = ["".join(g.choice([*"abcdefghijklmnopqrstuvwxyz "], size)).encode() for size in (70, 150, 300, 500) for _ in range(12)]
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(texts)), np.arange(len(texts))))
    a, b = a[(a < b) & (a // 12 == b // 12)], b[(a < b) & (a // 12 == b // 12)]
    compared, side_by_side = [], line_parts._abreast
    monkeypatch.setattr(line_parts, "_abreast", lambda *x, **y: compared.append(len(x[3])) or side_by_side(*x, **y))
    assert not line_parts.Texts(texts).alike(a, b, 80).any() and sum(compared) <= len(a) // 4


@pytest.mark.parametrize("lone", [0, 24, 10 ** 6])
def test_pairs_of_groups_held_together_need_not_be_compared(monkeypatch, lone):
    monkeypatch.setattr(line_parts, "_LONE", lone)  # many side by side, a few of them, or each alone
    g = np.random.default_rng(9)
    texts, alone, together = [], edit_distance, []
    for size in (30, 66, 150, 300, 900, 1500):
        seed = g.choice([*"abcdefgh \u00e9"], size).tolist()
        for share in (0, 0.03, 0.06, 0.08, 0.1, 0.12, 0.3):
            other = list(seed)
            for i in g.choice(size, int(size * share), replace=False).tolist():
                other[i] = str(g.choice([*"xyz"])) * int(g.integers(3))
            texts.append("".join(other).encode())
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(texts)), np.arange(len(texts))))
    a, b = a[a < b], b[a < b]
    want = np.array([alone(texts[i], texts[j], max(len(texts[i].decode()), len(texts[j].decode())) // 5) is not None for i, j in zip(a, b)])
    lines = line_parts.Texts(texts)
    assert (lines.alike(a, b, 80) == want).all()
    start = np.arange(len(texts)) // 2 * 2  # some are in one group already
    for group in (np.arange(len(texts)), start):
        got = lines.alike(a, b, 80, group)
        together = [line_parts._joined(group, group[a[x]], group[b[x]]) for x in (got, want)]
        assert not (got & ~want).any() and got.sum() < want.sum()
        assert len({*zip(*(x.tolist() for x in together))}) == len({*together[0].tolist()}) == len({*together[1].tolist()})


def test_one_pair_ends_early_and_only_where_it_may():
    g = np.random.default_rng(10)
    for size in (100, 300, 700):
        x = "".join(g.choice([*"abcd"], size))
        for y in ("".join(g.choice([*"abcd"], size)), x[: size // 3] + x[size // 3 + 9:], x[5:] + "dcbad", "b" * 20 + x[:-20]):
            d = edit_distance(x.encode(), y.encode(), 10 ** 6)
            assert edit_distance(x.encode(), y.encode(), d) == d and edit_distance(x.encode(), y.encode(), d - 1) is None


def test_a_crowd_that_does_not_link_makes_no_rows_of_pairs(spark, monkeypatch):
    g = np.random.default_rng(6)
    word = lambda n: "".join(g.choice([*"abcdefghijklmnopqrstuvwxyz"], n))
    common = " ".join(word(7) for _ in range(6))
    rows = [(i, f"{common} {word(24)}") for i in range(40)]
    rows += [(40, rows[7][1][:-1] + "0"), (41, "0" + rows[21][1][1:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    written, materialize = [], linking.materialize

    def told(df):
        written.append(materialize(df))
        return written[-1]

    for module in (line_parts, linking):
        monkeypatch.setattr(module, "materialize", told)
        monkeypatch.setattr(module, "discard", lambda *frames: None)
    want = sorted(line_dedup(docs).collect())
    assert [r.doc_id for r in want if r.n_lines_removed] == [40, 41]
    assert max(df.count() for df in written if df.columns == ["a", "b"]) <= 2 * len(rows)
    monkeypatch.setattr(line_parts, "_CROWD", 5)  # dealt out by pairs of blocks
    assert sorted(line_dedup(docs).collect()) == want


def test_every_prefix_is_found_and_edges_stand_by_node_and_length():
    vocab = pieces.vocabulary(MODEL)
    assert (vocab.find(vocab.keys) == np.arange(len(vocab.keys))).all()
    other = np.random.default_rng(7).integers(0, 2 ** 63, 200_000).astype(np.uint64)
    assert (vocab.find(other[~np.isin(other, vocab.keys)]) == -1).all()
    lattice = pieces.Lattice(["▁the", "\n", "▁☃a漢\U0010ffff", "▁▁"], vocab, 1.0)
    edges = list(zip(lattice.src.tolist(), lattice.dst.tolist()))
    assert edges == sorted(set(edges)) and (lattice.ids < 0).sum() >= 1
