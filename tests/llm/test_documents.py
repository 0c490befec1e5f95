"""Operators over documents against plain versions, with awkward rows."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from wattloom.llm import boosting, pii
from wattloom.llm import ngram_join as joined
from wattloom.llm import substrings
from wattloom.llm.decontaminate import decontaminate
from wattloom.llm.linking import components
from wattloom.llm.ngram_join import ngram_join
from wattloom.llm.pii import find_pii
from wattloom.llm.quality import quality_rules
from wattloom.llm.substrings import deep_nodes, substring_dedup

SCHEMA = "doc_id long, text string, lang string, n_words long, start int, key string, id long"


def corpus(seed=1, n=120):
    """Random texts with shared passages, copies, near copies, repeated rows, nulls, empties and odd characters."""
    r = random.Random(seed)
    vocab = [a + b for a in ("ka", "Lo", "mi", "ÑU", "te", "x") for b in ("ra", "ne", "SO", "é", "1")]
    text = lambda k: " ".join(r.choice(vocab) for _ in range(k))
    passage, line = text(30), text(16)
    rows = []
    for i in range(n):
        t = text(r.randint(1, 60))
        kind = i % 8
        if kind == 1:
            t = f"{t}\n{passage} {text(5)}"
        elif kind == 2:
            t = rows[r.randrange(len(rows))][1] or t
        elif kind == 3:
            w = (rows[r.randrange(len(rows))][1] or t).split(" ")
            w[r.randrange(len(w))] = "changed"
            t = " ".join(w)
        elif kind == 4:
            t = f"{line}\n{t}\t\x0b{line}\r\n{line}"
        rows.append((i * 7 % n, t))
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (None, passage), rows[5], rows[5], (1003, "one"), (1004, "One"),
             (1005, "two words"), (1006, text(3000)), (1007, passage), (7, passage + " other text under an id that is taken")]
    return rows


def frame(spark, rows):
    full = [(d, t, "en", 7, 1, "k", -1) for d, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def same(got, want):
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.mark.parametrize("slab,cell", [(8_000_000, 400_000), (2_000, 300)])
def test_substrings(spark, rows, slab, cell):
    got = substring_dedup(frame(spark, rows), size=13, slab_chars=slab, cell_suffixes=cell)
    same(got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect(), brute.substrings(rows))


def test_substrings_one_passage_everywhere(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    rows = [(i, f"a{i} {passage} b{i}") for i in range(60)]
    got = substring_dedup(frame(spark, rows), slab_chars=600, cell_suffixes=100, with_text=True).orderBy("doc_id").collect()
    assert got[0].n_removed == 0 and got[0].removed == []
    assert all(r.n_removed == 20 and r.kept == f"a{r.doc_id} b{r.doc_id}" and r.removed[0].start == 1 for r in got[1:])


def test_a_window_is_hashed_once_by_its_slab():
    words = [b"w%d" % i for i in range(30)]
    slab = substrings._Slab([9, 4, 1, 7], [b" ".join(words[:20]), b" ".join(words[5:25]), None, b" ".join(words)], 13)
    assert substrings._cells(slab.hashes[0], 13, 6).shape == (len(substrings.DEPTHS), 8)
    hot = np.ones((len(substrings.DEPTHS), 64), bool)  # no prefix is short enough: the window's own cell
    assert (slab.group(hot, 6) == (len(substrings.DEPTHS) << 6) + (slab.windows[slab.distinct] >> np.uint64(58)).astype(np.int64)).all()


def test_deep_nodes_number_equal_labels():
    edges = np.array([[1, 2], [1, 3], [1, 2], [0, 2], [1, 2]], np.uint64)
    node = deep_nodes(edges)
    assert node[0] == node[2] == node[4] and len({*node.tolist()}) == 3


def test_ngram_join(spark, rows):
    rows = [r for r in rows if r[0] is not None and r[0] != 7]
    got = ngram_join(frame(spark, rows), size=3, percent=90)
    same(got.collect(), brute.ngram_join(rows))


def test_ngram_join_chain_and_large_group(spark):
    """Near copies whose links form a chain, and many near copies of one text: components, not cliques."""
    base = [f"w{i}" for i in range(120)]
    chain = [(i, " ".join(base[i * 2:] + [f"c{j}" for j in range(i * 2)])) for i in range(12)]
    crowd = [(100 + i, " ".join([f"g{j}" if j != 17 + i % 70 else f"own{i}" for j in range(150)])) for i in range(300)]
    rows = chain + crowd
    same(ngram_join(frame(spark, rows), size=3, percent=90).collect(), brute.ngram_join(rows))


def test_ngram_join_within_a_group(spark):
    """Texts of one size and one prefix that no other text shares: links that leave out the smallest id are found too."""
    base = [f"r{i}" for i in range(100)]
    swapped = lambda at: [f"s{i}" if i in at else w for i, w in enumerate(base)]
    a, b, c = swapped([20, 40]), swapped([]), swapped([60])
    # what tells the three apart is frequent, so their rarest tokens are those they all have
    passages = " ".join(" ".join(t[i - 2:i + 3]) for t in (a, b, c) for i in (20, 40, 60))
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c))]
    rows += [(10 + k, " ".join([passages, *(f"f{k}_{i}" for i in range(200))])) for k in range(16)]
    got = ngram_join(frame(spark, rows), size=3, percent=90).collect()
    assert {r.doc_id: r.component_id for r in got if r.doc_id < 10} == {1: 1, 2: 2, 3: 2}
    same(got, brute.ngram_join(rows))


def test_ngram_join_of_a_crowd_without_links(spark, monkeypatch):
    """Many texts that share rare tokens but are too far apart: most pairs end within the join of the second round."""
    rows = [(i, " ".join(f"own{i}_{j}" if i <= j < i + 5 else f"g{j}" for j in range(100))) for i in range(5, 85)]
    told, plain = [], joined.linked

    def counted(*args, prune, **more):
        return plain(*args, prune=lambda pairs: told.append(pairs.count()) or prune(pairs), **more)

    monkeypatch.setattr(joined, "linked", counted)
    same(ngram_join(frame(spark, rows), size=3, percent=90).collect(), brute.ngram_join(rows))
    assert 0 < told[0] < 80 and told[1] < 800  # of 3160 pairs


def test_components(spark):
    r = random.Random(3)
    for n, m in ((40, 30), (60, 25)):
        edges = [(r.randrange(n), r.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(200, 230)]
        root = brute.components(300, edges)
        got = dict(components(spark.createDataFrame(edges + [(5, None)], "a long, b long")).collect())
        nodes = {x for e in edges for x in e if e[0] != e[1]}
        assert got == {i: root[i] for i in nodes}


def test_decontaminate(spark, rows):
    text = lambda i: rows[i][1]
    items = [(1, " ".join(text(1).split()[:12])), (2, text(3)), (10, "two words"), (4, "ONE"), (5, None), (6, "..."), (None, "ka ra"),
             (7, "never seen words in any place of the table at all"), (7, text(6)), (8, " ".join(text(125 % len(rows)).split()[:25]) if text(125 % len(rows)) else "x")]
    bench = spark.createDataFrame([(a, b, "x") for a, b in items], "item_id long, text string, doc_id string")
    got = decontaminate(frame(spark, rows), bench, window=10)
    want = brute.decontaminate(rows, items)
    same([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got.collect()], [(*w[:4], w[5]) for w in want])


def test_quality(spark, rows):
    labels = spark.createDataFrame([(d, i % 2, 0) for i, (d, _) in enumerate(rows)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality_rules(frame(spark, rows), labels)
    same([tuple(r)[:7] for r in got.collect()], brute.quality(rows))
    assert all(not r.kept for r in got.collect() if r.base_failed)


def test_quality_falls_with_its_constrained_shares(spark):
    from wattloom.llm import boosting

    g = np.random.default_rng(0)
    x = g.random((800, 3))
    y = (x[:, 0] + 0.3 * g.random(800) < 0.6) ^ (g.random(800) < 0.1)
    forest = boosting.fit(x, y, monotone={0: -1})
    grid = np.repeat(g.random((50, 3)), 21, axis=0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 21), 50)
    assert (np.diff(forest.raw(grid).reshape(50, 21), axis=1) <= 1e-12).all()
    assert ((forest.probability(x) > 0.5) == y).mean() > 0.85
    sql = spark.createDataFrame(x[:50].tolist(), "a double, b double, c double").selectExpr(forest.sql(["a", "b", "c"])).collect()
    assert np.allclose([r[0] for r in sql], forest.raw(x[:50]), atol=1e-6)


def test_pii(spark):
    texts = ["mail a@b.co_x@d.e or a@b.c.d@e.f", "x@y.z-foo@q.r a@b", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.255", "4111 1111 1111 1111 and 4111-1111-1111-1112",
             "+1 (456) 555-2186, +12 3, ++4 (55) 66.77-88 99+1", "ñé 10.0.0.1é+49 30 1234567", "", None, "9" * 5000, "a" * 5000 + "@", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (3, texts[3]), (3, texts[3])]
    got = find_pii(frame(spark, rows)).collect()
    written = [(r.doc_id, ",".join(f"{s.kind}:{s.start}:{s.stop}" for s in r.base)) for r in got]
    same(written, [(w[0], w[6]) for w in brute.pii(rows)])


def test_pii_adds_no_overlap(spark):
    r = random.Random(5)
    phone = lambda: f"+1 ({r.randrange(100, 999)}) 555-{r.randrange(1000, 9999)}"
    rows = [(i, f"call {phone()} now, order {r.randrange(10 ** 9)} of {r.randrange(10 ** 7)} ({r.randrange(100, 999)}) 555-{r.randrange(1000, 9999)}") for i in range(200)]
    for row in find_pii(frame(spark, rows)).collect():
        spans = sorted((s.start, s.stop) for s in row.base + row.added)
        assert len(row.base) >= 1 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]) if b in [(s.start, s.stop) for s in row.added])


def test_pii_adds_what_base_patterns_miss(spark):
    r = random.Random(9)
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    rows, want = [], {}
    for i in range(150):
        parts = [("email", f"name{i} (at) host (dot) com"), ("ip", ":".join(f"{r.randrange(4096, 65536):x}" for _ in range(8))),
                 ("phone", f"({digits(3)}) {digits(3)}-{digits(4)}")]
        text = f"write {parts[0][1]} or host {parts[1][1]} or phone {parts[2][1]} now, order {digits(9)} of 10:20:30:40, 300.400.1.{digits(2)}"
        rows.append((i, text))
        want[i] = {(k, text.index(x), text.index(x) + len(x)) for k, x in parts}
    got = {row.doc_id: {tuple(s) for s in row.added} for row in find_pii(frame(spark, rows)).collect()}
    for kind in ("email", "ip", "phone"):
        found = sum(len({s for s in want[i] & got[i] if s[0] == kind}) for i in want)
        assert found >= 140, (kind, found)
    wrong = [(s, rows[i][1][s[1]:s[2]]) for i in got for s in got[i] if s[1] >= rows[i][1].index("order")]
    assert not wrong, wrong[:5]


def test_trees_of_all_rows_do_not_depend_on_their_order(spark):
    g = np.random.default_rng(4)
    x = np.round(g.random((1200, 3)) * [9, 300, 0.5], 2)
    y = x[:, 0] / 9 + x[:, 1] / 300 > 1
    rows = [(m, i % 3 == 2, bool(v if m == "a" else m == "c" or not v), x[i].tolist()) for i, v in enumerate(y) for m in "abc"]
    rows = spark.createDataFrame(rows, "model string, held boolean, y boolean, x array<double>")
    fit = lambda r: boosting.fit_all(r, 3, trees=6, depth=3, rate=0.4, precision=0.95)
    got, again = fit(rows.repartition(3)), fit(rows.orderBy(F.desc("x")).repartition(7, "x"))
    assert sorted(got) == sorted(again) == ["a", "b"]  # c has one class
    for m in got:
        (forest, at), (other, lowest) = got[m], again[m]
        assert at == lowest is not None and all(np.array_equal(getattr(forest, k), getattr(other, k)) for k in ("feature", "threshold", "left", "right", "value"))
        score, want = forest.raw(x[2::3]), y[2::3] if m == "a" else ~y[2::3]
        assert ((score > 0) == want).mean() > 0.9 and want[score >= at].mean() >= 0.95
        sql = spark.createDataFrame(x[:50].tolist(), "a double, b double, c double").selectExpr(forest.sql(["a", "b", "c"])).collect()
        assert np.allclose([r[0] for r in sql], forest.raw(x[:50]), atol=1e-6)


def test_pii_trees_are_fitted_on_all_labelled_candidates(spark, monkeypatch):
    r = random.Random(11)
    rows = [(i, " ".join(f"call +1 ({r.randrange(100, 999)}) 555-{r.randrange(1000, 9999)} order {r.randrange(10 ** 8, 10 ** 9)}" for _ in range(50))
             + f" mail a{i} (at) b{i} (dot) com") for i in range(100)]
    seen, fit_all = [], boosting.fit_all

    def told(found, *a, **k):
        seen.append({m.model: m["count"] for m in found.groupBy("model").count().collect()})
        return fit_all(found, *a, **{**k, "trees": 2})
    monkeypatch.setattr(boosting, "fit_all", told)
    models = pii.train(frame(spark, rows))
    assert seen[0]["phone"] >= 10000 and seen[0]["all"] >= 10100
    assert {"phone", "email"} <= set(models)  # e-mails have one class: trees of all kinds


def test_empty_tables(spark):
    none = frame(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert substring_dedup(none).count() == ngram_join(none).count() == decontaminate(none, bench).count() == 0
    assert quality_rules(none, labels).count() == find_pii(none).count() == 0
    assert decontaminate(frame(spark, [(1, "a b")]), bench).collect()[0].contaminated is False
