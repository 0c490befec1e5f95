"""Product codes of vectors; nearest entries are found over tries of distinct parts.

Every task sorts the distinct parts of a block of vectors by their integers,
dimension by dimension: a trie whose nodes are runs of the sorted rows.  Going
down, a node's 64 (or fewer) entry distances so far are its parent's plus one
squared difference, so parts with a common beginning share that work.  Small
subtrees are expanded a level at a time, larger ones child by child, which
bounds memory.  A leaf is one distinct part: it takes the nearest entry and
adds its integers, times the number of rows that hold it, to that entry's sum.
Only those sums are shuffled (parts x entries rows a task), never vectors.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.llm.common import if_small
from wattloom.session import materialize

#: Leaves of a subtree that is expanded at once, and vectors of a block.
_LEAVES, _BLOCK = 2_048, 16_384
#: Integers below this keep every distance exact in 64 bits (parts of up to 1024 dimensions).
_SAFE = 1 << 26


def scaled(vectors: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are kept (not null, every component finite) and floor(scale * x) of theirs, as an integer matrix.

    Integers past 64-bit range of squares are Python's, so nothing overflows.
    """
    if not len(vectors):
        return np.zeros(0, bool), np.empty((0, 0), np.int64)
    sizes = np.array(vectors.value_lengths().fill_null(0))
    values = np.array(vectors.flatten().cast(pa.float64()).fill_null(float("nan")), float)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    stop = np.cumsum(sizes)
    keep = np.array(vectors.is_valid()) & (bad[stop] == bad[stop - sizes])
    widths = np.unique(sizes[keep])
    if len(widths) > 1:
        raise ValueError(f"vectors of {widths[0]} and of {widths[-1]} components in one table")
    width = int(widths[0]) if len(widths) else 0
    floor = np.floor(values[np.repeat(keep, sizes)] * scale)
    if not np.isfinite(floor).all():
        floor = np.array([v * scale // 1 for v in map(int, values[np.repeat(keep, sizes)])], object)
    if floor.dtype == object or (len(floor) and np.abs(floor).max() >= _SAFE):
        whole = np.array([int(v) for v in floor.tolist()], object)
    else:
        whole = floor.astype(np.int64)
    return keep, whole.reshape(int(keep.sum()), width)


def distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, each row's place among them, and how often each occurs."""
    order = np.lexsort(rows.T[::-1]) if rows.shape[1] else np.arange(len(rows))
    ordered = rows[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    place = np.empty(len(rows), np.int64)
    place[order] = np.cumsum(fresh) - 1
    return ordered[fresh], place, np.bincount(place, minlength=int(fresh.sum()))


def trie_nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (the lowest of equals) and its squared distance, for sorted distinct ``parts``."""
    n, width = parts.shape
    nearest, distance = np.zeros(n, np.int64), np.zeros(n, parts.dtype)
    # neighbouring nodes of one depth: where their leaves start, where the last one's stop, distances over the dimensions so far
    stack = [(np.zeros(1, np.int64), n, 0, np.zeros((1, len(entries)), parts.dtype))] if n else []
    while stack:
        starts, high, depth, so_far = stack.pop()
        low = int(starts[0])
        if high - low > _LEAVES and len(starts) > 1:
            cuts = np.flatnonzero(np.diff((starts - low) // _LEAVES)) + 1
            if not len(cuts):
                cuts = np.array([1])
            for a, b in reversed(list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(starts)]))):
                stack.append((starts[a:b], int(starts[b]) if b < len(starts) else high, depth, so_far[a:b]))
            continue
        block = parts[low:high]
        node = np.zeros(high - low, np.int64)
        node[starts[1:] - low] = 1
        node = np.cumsum(node)
        while depth < width:
            fresh = np.ones(high - low, bool)
            fresh[1:] = (node[1:] != node[:-1]) | (block[1:, depth] != block[:-1, depth])
            first = np.flatnonzero(fresh)
            so_far = so_far[node[first]] + (block[first, depth][:, None] - entries[:, depth]) ** 2
            depth, node = depth + 1, np.cumsum(fresh) - 1
            if high - low > _LEAVES:
                break
        if depth < width:
            stack.append((first + low, high, depth, so_far))
            continue
        if len(so_far) < high - low:  # parts without dimensions
            so_far = so_far[node]
        nearest[low:high] = so_far.argmin(axis=1)
        distance[low:high] = so_far[np.arange(high - low), nearest[low:high]]
    return nearest, distance


def _split(rows: np.ndarray, parts: int) -> np.ndarray:
    """Positions x rows x width of a part."""
    if rows.shape[1] % parts:
        raise ValueError(f"vectors of {rows.shape[1]} components are not {parts} equal parts")
    return rows.reshape(len(rows), parts, rows.shape[1] // parts).transpose(1, 0, 2)


def _blocks(batch, column: str, scale: int):
    for a in range(0, batch.num_rows, _BLOCK):
        block = batch.slice(a, _BLOCK)
        yield block, *scaled(block.column(column), scale)


def _same_kind(rows: np.ndarray, books: list) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers, or both as Python's where either is too large for them."""
    own = np.array(books, object)
    if rows.dtype != object and (not own.size or max(map(abs, own.ravel().tolist())) < _SAFE):
        return rows, own.astype(np.int64)
    return rows.astype(object), own


def _sums(books: list, column: str, parts: int, scale: int):
    """Per part position and entry: how many parts are nearest to it, and their sums."""
    def run(batches):
        total, count = {}, {}
        for batch in batches:
            for _, _, rows in _blocks(batch, column, scale):
                if not len(rows):
                    continue
                rows, own = _same_kind(rows, books)
                for p, block in enumerate(_split(rows, parts)):
                    leaves, _, weight = distinct_rows(block)
                    nearest, _ = trie_nearest(leaves, own[p])
                    for e in np.unique(nearest).tolist():
                        at = nearest == e
                        here = [sum(c) for c in zip(*(leaves[at].astype(object) * weight[at].astype(object)[:, None]).tolist())] \
                            if leaves.dtype == object else (leaves[at] * weight[at][:, None]).sum(axis=0).tolist()
                        old = total.get((p, e))
                        total[p, e] = here if old is None else [x + y for x, y in zip(old, here)]
                        count[p, e] = count.get((p, e), 0) + int(weight[at].sum())
        if total:
            keys, kind = list(total), pa.decimal128(38)
            flat = [(p, e, d, Decimal(v), count[p, e]) for p, e in keys for d, v in enumerate(total[p, e])]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*flat), (pa.int32(), pa.int32(), pa.int32(), kind, pa.int64()))],
                                  ["part", "entry", "place", "total", "n"])
    return run


def _codes(books: list, column: str, parts: int, scale: int, names: list[str]):
    def run(batches):
        for batch in batches:
            for block, keep, rows in _blocks(batch, column, scale):
                if not len(rows):
                    continue
                rows, own = _same_kind(rows, books)
                code, error = np.empty((parts, len(rows)), np.uint8), np.zeros(len(rows), rows.dtype)
                for p, part in enumerate(_split(rows, parts)):
                    leaves, place, _ = distinct_rows(part)
                    nearest, distance = trie_nearest(leaves, own[p])
                    code[p], error = nearest[place], error + distance[place]
                errors = pa.array([Decimal(int(v)) if abs(v) < 10 ** 38 else None for v in error.tolist()], pa.decimal128(38)) \
                    if rows.dtype == object else pa.array(error).cast(pa.decimal128(38))
                kept = block.filter(pa.array(keep))
                yield pa.record_batch([*kept.columns, pa.array([c.tobytes() for c in np.ascontiguousarray(code.T)], pa.binary()), errors],
                                      [*names, "code", "error"])
    return run


def fit_codebooks(vectors: DataFrame, *, column: str = "embedding", id_column: str = "vec_id", parts: int = 16, entries: int = 64,
                  rounds: int = 2, scale: int = 256) -> list[list[list[int]]]:
    """Entries by part position: those parts of the rows with the smallest ids, then ``rounds`` rounds of means.

    Components are floor(scale * x).  A round replaces each entry by
    floor(sum / count) of the parts nearest to it; an entry without parts
    stays.  All rows take part in every round.  Rows with one id are taken in
    the order of their vectors, a null id comes last; with fewer rows than
    ``entries`` there are as many entries.  Rows whose vector is null or holds
    a null or a component that is not finite are left out; without any row the
    result is empty.  At most 256 entries.
    """
    if not 0 < entries <= 256:
        raise ValueError("1 to 256 entries")
    ok = F.expr(f"`{column}` is not null and forall(`{column}`, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    rows = vectors.where(ok).select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{column}`").cast("array<double>").alias("v"))
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).toArrow()
    _, seeds = scaled(first.column("v").combine_chunks(), scale)
    if not len(seeds):
        return []
    books = [[[int(v) for v in entry] for entry in part.tolist()] for part in _split(seeds, parts)]
    for _ in range(rounds):
        found = vectors.select(F.col(f"`{column}`").alias("v")).mapInArrow(
            _sums(books, "v", parts, scale), "part int, entry int, place int, total decimal(38,0), n long")
        found = found.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
        for part, entry, place, total, n in found.collect():  # one row an integer of the codebooks
            books[part][entry][place] = int(total) // int(n)
    return books


def digest(books: list) -> str:
    """SHA-256 of all integers by part, entry and position within the part."""
    return hashlib.sha256(",".join(str(v) for part in books for entry in part for v in entry).encode()).hexdigest()


def compress(vectors: DataFrame, books: list, *, column: str = "embedding", label: str = "label", scale: int = 256) -> DataFrame:
    """Every kept row of ``vectors`` with ``code``, ``error`` and ``label_error``.

    ``code`` (binary) holds the index of each part's nearest entry, a byte a
    part; ``error`` the squared distances summed over the parts and
    ``label_error`` the errors summed over rows of an equal label, nulls
    together (both decimal, exact; an error of 39 digits is null and in no
    sum).  Columns of those names are replaced, all others stay.  Rows are left out as in ``fit_codebooks``; repeated rows stay,
    each with its own code.  An empty table, or one without a usable vector,
    gives no rows.  Nothing but label sums is shuffled below 200,000 labels;
    beyond, rows join their label's sum by a shuffle.
    """
    names = [c for c in vectors.columns if c not in ("code", "error", "label_error")]
    kept = vectors.select(*[F.col(f"`{c}`") for c in names])
    schema = T.StructType([*kept.schema.fields]).add("code", "binary").add("error", "decimal(38,0)")
    coded = materialize(kept.mapInArrow(_codes(books, column, len(books), scale, names), schema)) if books else kept.limit(0) \
        .select("*", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("decimal(38,0)").alias("error"))
    sums = coded.groupBy(F.col(f"`{label}`").alias("__of")).agg(F.sum("error").alias("label_error"))
    same = coded[f"`{label}`"].eqNullSafe(sums["__of"])
    return coded.join(if_small(sums), same, "left").drop(sums["__of"])
