"""Vector codes, whitening and byte-level tokens against plain versions, with awkward rows."""

import base64
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from compare import DATA
from wattloom.llm import byte_bpe, vector_codes, whitening
from wattloom.llm.queries import RANKS

VECTORS = "vec_id long, embedding array<float>, label int, code string, whitened string, i int, total long"


def single(v):
    return None if v is None else [None if x is None else float(np.float32(x)) for x in v]


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "c", "w", 1, 2) for i, v, label in rows], VECTORS).repartition(3)


def awkward(width=32, seed=1):
    """Random vectors, ties, repeated rows and vectors, nulls, null and non-finite entries."""
    r = random.Random(seed)
    rows = [(i * 7 % 500, [r.gauss(0, .1) for _ in range(width)], r.choice([1, 2, None])) for i in range(200)]
    rows += [(5, None, 1), (6, [None] * width, 2), (7, [float("nan")] + [0.] * (width - 1), 1), (8, [float("-inf")] + [0.] * (width - 1), 1),
             (None, [.5] * width, 3), rows[0], rows[0], (0, [.25] * width, None)]
    rows += [(1000 + i, [r.choice([0., .1, -.1]) for _ in range(width)], None) for i in range(60)]
    rows += [(2000 + i, rows[3][1], 2) for i in range(40)]
    return [(i, single(v), label) for i, v, label in rows]


def usable(rows):
    return [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]


# ---- vector codes


def plain_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in usable(rows)]
    if not kept:
        return [], None
    w = len(kept[0][1]) // parts
    cut = lambda x, p: x[p * w:p * w + w]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(r[1], p) for r in first] for p in range(parts)]
    near = lambda p, v: min((sum((a - b) ** 2 for a, b in zip(v, e)), j) for j, e in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            held = {}
            for _, x, _ in kept:
                held.setdefault(near(p, cut(x, p))[1], []).append(cut(x, p))
            new.append([[sum(c) // len(c) for c in zip(*held[j])] if j in held else e for j, e in enumerate(books[p])])
        books = new
    found = [(i, [near(p, cut(x, p)) for p in range(parts)], label) for i, x, label in kept]
    errors = {}
    for _, best, label in found:
        errors[label] = errors.get(label, 0) + sum(d for d, _ in best)
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return [(i, "".join(f"{j:02x}" for _, j in best), sum(d for d, _ in best), errors[label]) for i, best, label in found], digest


@pytest.mark.parametrize("leaves", [2_048, 8])
@pytest.mark.parametrize("parts,entries,rounds", [(16, 64, 2), (4, 10, 3)])
def test_codes_equal_plain_version(spark, monkeypatch, leaves, parts, entries, rounds):
    monkeypatch.setattr(vector_codes, "_LEAVES", leaves)
    rows = awkward()
    df = vector_frame(spark, rows)
    books = vector_codes.fit_codebooks(df, parts=parts, entries=entries, rounds=rounds)
    out = vector_codes.compress(df, books)
    assert out.columns == ["vec_id", "embedding", "label", "whitened", "i", "total", "code", "error", "label_error"]
    want, digest = plain_codes(rows, parts, entries, rounds)
    got = [(r.vec_id, r.code.hex(), int(r.error), int(r.label_error)) for r in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and vector_codes.digest(books) == digest


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [.5] * 16, None)], [(1, [1e12] * 16, 1), (2, [-3e11] * 16, 1), (3, [.1] * 16, 1)]])
def test_codes_of_few_or_large_vectors(spark, rows):
    df = vector_frame(spark, [(i, single(v), label) for i, v, label in rows])
    out = vector_codes.compress(df, vector_codes.fit_codebooks(df, entries=2))
    want, _ = plain_codes([(i, single(v), label) for i, v, label in rows], entries=2)
    assert sorted((r.vec_id, r.code.hex(), int(r.error), int(r.label_error)) for r in out.collect()) == sorted(want)


@pytest.mark.parametrize("leaves", [1, 5, 64, 5_000])
def test_trie_takes_the_nearest_entry(monkeypatch, leaves):
    monkeypatch.setattr(vector_codes, "_LEAVES", leaves)
    rng = np.random.default_rng(leaves)
    for spread in (1, 3, 100):
        rows = rng.integers(-spread, spread + 1, (700, 4))
        parts, place, count = vector_codes.distinct_rows(rows)
        assert (parts[place] == rows).all() and count.sum() == 700 and [*map(tuple, parts)] == sorted({*map(tuple, rows)})
        entries = rng.integers(-spread, spread + 1, (9, 4))
        distances = ((parts[:, None] - entries) ** 2).sum(axis=2)
        nearest, distance = vector_codes.trie_nearest(parts, entries)
        assert (nearest == distances.argmin(axis=1)).all() and (distance == distances.min(axis=1)).all()


def test_codes_refuse_unequal_parts(spark):
    with pytest.raises(Exception, match="equal parts|one table"):
        vector_codes.fit_codebooks(vector_frame(spark, [(1, [.5] * 15, 1)]))


# ---- whitening


def plain_whitening(rows, count=16):
    kept = [(i, [math.floor(64 * x) + 1_000_000 for x in v]) for i, v, _ in usable(rows)]
    distinct = sorted({tuple(x) for _, x in kept})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    y = np.array([[n * a - s for a, s in zip(x, sums)] for x in distinct], float) / max(n, 1)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)[:count]
    order = [o for o in order if values[o] > 1e-9 * max(1, values.max())]
    out = {}
    for i, x in kept:
        away = [n * a - s for a, s in zip(x, sums)]
        out.setdefault(i, []).append((sum(a * a for a in away), np.array(away) / n @ vectors[:, order] / np.sqrt(values[order])))
    return n, out, values[order] / values.sum()


@pytest.mark.parametrize("width", [32, 5])
def test_whitening_equals_eigenvectors(spark, width):
    rows = awkward(width, seed=3)
    df = vector_frame(spark, rows)
    fitted = whitening.fit(df)
    out = whitening.whiten(df, fitted)
    assert out.columns == ["vec_id", "embedding", "label", "code", "i", "total", "whitened", "deviation"]
    n, want, explained = plain_whitening(rows)
    assert fitted.n == n and np.allclose(fitted.explained, explained, rtol=1e-9) and fitted.identity_error < 1e-9
    got = {}
    for r in out.collect():
        got.setdefault(r.vec_id, []).append((int(r.deviation), np.array(r.whitened)))
    assert got.keys() == want.keys()
    signs = None
    for i, found in want.items():
        assert sorted(d for d, _ in found) == sorted(d for d, _ in got[i])
        for (_, a), (_, b) in zip(sorted(found, key=lambda x: (x[0], str(np.abs(x[1]).round(6)))), sorted(got[i], key=lambda x: (x[0], str(np.abs(x[1]).round(6))))):
            signs = np.sign(a * b) if signs is None else signs
            assert np.allclose(a * signs, b, atol=1e-7)


def test_whitening_of_flat_tables(spark):
    """Directions without variance have no component; equal eigenvalues share any orthonormal basis; large offsets cost no digits."""
    for rows in ([], [(1, None, 1)], [(1, [.5, .5], 1), (2, [.5, .5], 1)]):
        df = vector_frame(spark, rows)
        fitted = whitening.fit(df)
        out = whitening.whiten(df, fitted).collect()
        assert not fitted.eigenvalues and [(r.whitened, int(r.deviation)) for r in out] == [([], 0)] * len(usable(rows))
    corners = [[s * 4. if j == k else 0. for j in range(3)] + [1.] for k in range(3) for s in (1, -1)]
    df = vector_frame(spark, [(i, v, 1) for i, v in enumerate(corners)])
    fitted = whitening.fit(df)
    assert len(fitted.eigenvalues) == 3 and np.allclose(fitted.explained, 1 / 3) and fitted.identity_error < 1e-9
    far = spark.createDataFrame([(i, [2.0 ** 40 + a, 2.0 ** 41 - a * a]) for i, a in enumerate([0., 1., 2., 5.])], "vec_id long, embedding array<double>")
    fitted = whitening.fit(far)
    assert fitted.identity_error < 1e-6 and len(fitted.eigenvalues) == 2


def test_characteristic_polynomial_and_roots():
    rng = np.random.default_rng(5)
    for d in (1, 2, 7, 12):
        rows = rng.integers(-40, 40, (d + 2, d))
        matrix = (rows.T @ rows).astype(object)
        if d == 7:
            matrix[:, 3] = matrix[3, :] = 0
        trace = int(sum(matrix.diagonal()))
        primes = whitening.primes_beyond(2 * (2 + trace // d) ** d)
        poly = whitening.chinese_remainder([whitening.charpoly_mod(matrix, p) for p in primes], primes)
        # Faddeev and LeVerrier's recursion, exact in integers
        want, m = [1], np.zeros((d, d), object)
        for k in range(1, d + 1):
            m = matrix.dot(m) + want[-1] * np.eye(d, dtype=int).astype(object)
            want.append(-int(sum(matrix.dot(m).diagonal())) // k)
        assert poly == want[::-1]
        roots, bits = whitening.largest_roots(poly, 16, trace)
        values = np.linalg.eigvalsh(matrix.astype(float))[::-1]
        assert np.allclose([r / 2 ** (bits + 1) for r, _ in roots], values[:len(roots)]) and len(roots) == d - (d == 7)


def test_products_are_exact():
    rng = np.random.default_rng(2)
    for bits in (8, 24, 40, 60):
        rows = rng.integers(-2 ** bits, 2 ** bits, (300, 3))
        whole = rows.astype(object)
        assert (whitening.gram(rows) == whole.T @ whole).all()


# ---- byte-level tokens


def reference_tokens():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_rows():
    r = random.Random(3)
    parts = ["a", "b", "é", " ", "  ", "\n", "1", "22", "'", "'s", "'re", "!", "...", "日本", "🙂", " ", "word", "The"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 300)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " " * 300), (203, "a" * 300 + " " + "b" * 200), (204, "!" * 250 + "'s" + "x" * 99), (205, "'s" * 200),
             (206, "'" * 101 + "re" * 80), (207, " " * 64 + "word"), (208, "x" * 47 + "'ll be" * 30), (209, "1" * 500),
             (210, (" " * 33 + "!" * 40 + "a" * 70) * 5), (None, "null id"), rows[5], rows[5], (5, rows[6][1])]
    return rows


@pytest.mark.parametrize("chunk,overlap", [(32, 8), (40, 40), (32_768, 1_024)])
def test_tokens_equal_the_library(spark, chunk, overlap):
    rows, want = token_rows(), reference_tokens()
    df = spark.createDataFrame([(a, b, "x", 1, b"k", None) for a, b in rows], "doc_id long, text string, ids string, start int, key binary, row int")
    out = byte_bpe.decode(byte_bpe.encode(df.repartition(3), RANKS, chunk=chunk, overlap=overlap), RANKS)
    assert out.columns == ["doc_id", "text", "start", "key", "row", "ids", "decoded"]
    got = out.collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(rows, key=str)
    for r in got:
        assert list(r.ids) == want.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()


def test_tokens_of_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.decode(byte_bpe.encode(empty, RANKS), RANKS).collect() == []


def test_one_long_piece_is_merged_whole():
    want = reference_tokens()
    ranks = byte_bpe.parse_ranks(byte_bpe.read_ranks(RANKS))
    for text in ("a" * 20_000, "ab" * 5_000 + "abc" * 999, "é日" * 3_000):
        assert byte_bpe.merge(text.encode(), ranks) == want._core_bpe.encode_single_piece(text.encode())


def test_pieces_side_by_side_equal_pieces_alone(monkeypatch):
    monkeypatch.setattr(byte_bpe, "_KEPT", 300)
    want = reference_tokens()
    pieces = byte_bpe._Pieces(byte_bpe.parse_ranks(byte_bpe.read_ranks(RANKS)))
    r = random.Random(9)
    for _ in range(20):
        rows = [["".join(r.choice("abeéñ日 1'stre") for _ in range(r.randint(1, 30))) for _ in range(r.randint(0, 40))] for _ in range(9)]
        for row, ids in zip(rows, pieces.encode(rows)):
            assert ids.tolist() == [i for p in row for i in want._core_bpe.encode_single_piece(p.encode())]


def test_token_query_equals_the_library(spark):
    want, sf = reference_tokens(), f"{DATA}/sf0.001"
    got = {r.doc_id: r for r in __spark_entry__.queries()["op12_byte_bpe"](spark, sf).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(got)
    for doc_id, text in docs:
        ids, r = want.encode_ordinary(text or ""), got[doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode()))


def test_whitening_query(spark):
    sf = f"{DATA}/sf0.001"
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    n, want, explained = plain_whitening(rows)
    got = __spark_entry__.queries()["op13_whitening"](spark, sf)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    by = got.groupBy("component").agg(F.count(F.lit(1)).alias("rows"), F.min("explained").alias("low"), F.max("explained").alias("high"),
                                      F.max("identity_error").alias("error"), F.max("n").alias("n")).orderBy("component").collect()
    assert [b.component for b in by] == list(range(1, 17)) and all(b.rows == len(rows) and b.n == n and b.error < 1e-9 for b in by)
    assert np.allclose([b.low for b in by], explained) and all(b.low == b.high for b in by)
    assert {r.vec_id: r.deviation for r in got.collect()} == {i: f[0][0] for i, f in want.items()}
