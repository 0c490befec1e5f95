"""Substring dedup: suffix trees over groups of suffixes that share a prefix of variable length."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import as_bytes, mixed, window_hashes, word_hashes
from wattloom.session import materialize

#: Lengths in words that a group's prefix may have, before the whole window.
DEPTHS = (1, 2, 4)
#: Words under one edge of a tree.
EDGE = 5


def _cells(hashes: np.ndarray, size: int, bits: int) -> np.ndarray:
    """Cell of each window's prefix at every depth but the last, which is the window."""
    n = max(len(hashes) - size + 1, 0)
    return np.stack([(window_hashes(hashes, d)[:n] >> np.uint64(64 - bits)).astype(np.int64) for d in DEPTHS])


def _count_prefixes(size: int, bits: int):
    """Suffixes in each prefix cell: ``len(DEPTHS)`` rows of ``2 ** bits`` counters a task."""
    def run(batches):
        counts = np.zeros((len(DEPTHS), 1 << bits), np.int64)
        for batch in batches:
            for raw in as_bytes(batch.column("text")):
                words = raw.split() if raw else []
                if len(words) >= size:
                    cells = _cells(word_hashes(words), size, bits)
                    for d in range(len(DEPTHS)):
                        counts[d] += np.bincount(cells[d], minlength=1 << bits)
        yield pa.record_batch([pa.array(range(len(DEPTHS)), pa.int32()), pa.array([c.tobytes() for c in counts], pa.binary())],
                              ["depth", "counts"])
    return run


def _add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = 0
    for batch in batches:
        for part in batch.column("counts").to_pylist():
            total = total + np.frombuffer(part, np.int64)
    yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["depth", "counts"])


class _Slab:
    """The windows of one slab of documents."""

    def __init__(self, ids: list, texts: list, size: int):
        self.ids, self.size = ids, size
        hashes = [word_hashes(t.split()) if t else np.empty(0, np.uint64) for t in texts]
        self.lengths = np.array([len(h) for h in hashes], np.int64)
        self.hashes = hashes
        self.counts = np.maximum(self.lengths - size + 1, 0)
        self.windows = np.concatenate([np.empty(0, np.uint64), *(window_hashes(h, size) for h in hashes)])
        key = np.array([np.iinfo(np.int64).min if i is None else i for i in ids], np.int64)
        self.owner = np.repeat(key, self.counts)  # doc_id of each window
        order = np.lexsort((self.owner, self.windows))
        first = np.ones(len(order), bool)
        first[1:] = self.windows[order][1:] != self.windows[order][:-1]
        #: One window of each text, by hash, at the smallest doc_id that has it.
        self.distinct = order[first]
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.cumsum(first) - 1

    def group(self, hot: np.ndarray, bits: int) -> np.ndarray:
        """Prefix group of each distinct window: the shortest prefix whose cell is not too large."""
        cells = np.concatenate([np.empty((len(DEPTHS), 0), np.int64),
                                *(_cells(h, self.size, bits) for h in self.hashes if len(h) >= self.size)], axis=1)[:, self.distinct]
        cells = np.concatenate([cells, [(self.windows[self.distinct] >> np.uint64(64 - bits)).astype(np.int64)]])
        depth = np.full(cells.shape[1], len(DEPTHS))
        for d in reversed(range(len(DEPTHS))):
            depth = np.where(hot[d][cells[d]], depth, d)
        return (depth << bits) + cells[depth, np.arange(cells.shape[1])]

    def edges(self, chosen: np.ndarray) -> np.ndarray:
        """Labels of the chosen windows, hashed ``EDGE`` words to an edge."""
        parts = []
        for h in self.hashes:
            n = len(h) - self.size + 1
            if n > 0:
                parts.append(np.stack([window_hashes(h[at:], min(EDGE, self.size - at))[:n] for at in range(0, self.size, EDGE)], axis=1))
        return np.concatenate(parts)[chosen] if parts else np.empty((0, -(-self.size // EDGE)), np.uint64)


def _slab(data: pa.Table, size: int) -> _Slab:
    return _Slab(data.column("doc_id").to_pylist(), [t for c in data.column("text").chunks for t in as_bytes(c)], size)


def _prints(windows: np.ndarray) -> np.ndarray:
    """32-bit fingerprint of windows, unlike the bits that chose their cell."""
    return mixed(windows ^ np.uint64(0x5851F42D4C957F2D)).astype(np.uint32)


def _packed(values: np.ndarray) -> bytes:
    """Ascending 32-bit values as their steps, in as few bytes each as the widest needs; the first byte says how many."""
    steps = np.diff(values, prepend=values[:1] * 0).astype("<u4")
    width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + steps.view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    width = raw[0]
    steps = np.zeros(((len(raw) - 1) // width, 4), np.uint8)
    steps[:, :width] = np.frombuffer(raw, np.uint8, offset=1).reshape(-1, width)
    return np.cumsum(steps.view("<u4").ravel(), dtype=np.uint64).astype(np.uint32)


def _parts(group: np.ndarray):
    """Index arrays of the equal values of ``group``."""
    order = np.argsort(group, kind="stable")
    values, starts = np.unique(group[order], return_index=True)
    return zip(values.tolist(), np.split(order, starts[1:])) if len(order) else ()


def _emit_prints(size, bits, hot):
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab = _slab(pa.Table.from_batches(list(batches)), size)
        prints = _prints(slab.windows[slab.distinct])
        rows = [(g, _packed(np.unique(prints[i]))) for g, i in _parts(slab.group(hot.value, bits))]
        for at in range(0, len(rows), 512):
            some = rows[at:at + 512]
            yield pa.record_batch([pa.array([g for g, _ in some], pa.int64()), pa.array([key[0].as_py()] * len(some), pa.int64()),
                                   pa.array([p for _, p in some], pa.binary())], ["prefix", "slab", "prints"])
    return run


def _shared_prints(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints of one prefix group that several slabs have, for each of those slabs."""
    slabs, prints = [], []
    for batch in batches:
        slabs += batch.column("slab").to_pylist()
        prints += [_unpacked(p) for p in batch.column("prints").to_pylist()]
    values, count = np.unique(np.concatenate(prints), return_counts=True)
    shared = values[count > 1]
    rows = [(s, _packed(got)) for s, p in zip(slabs, prints) if len(got := p[np.isin(p, shared, assume_unique=True)])]
    yield pa.record_batch([pa.array([s for s, _ in rows], pa.int64()), pa.array([key[0].as_py()] * len(rows), pa.int64()),
                           pa.array([p for _, p in rows], pa.binary())], ["slab", "prefix", "prints"])


def _emit_suffixes(size, bits, hot):
    def run(key, left, right):
        if not left.num_rows or not right.num_rows:
            return pa.table({"prefix": pa.array([], pa.int64()), "slab": pa.array([], pa.int64()), "first": pa.array([], pa.binary()),
                             "places": pa.array([], pa.binary()), "edges": pa.array([], pa.binary())})
        slab = _slab(left, size)
        shared = dict(zip(right.column("prefix").to_pylist(), right.column("prints").to_pylist()))
        prints = _prints(slab.windows[slab.distinct])
        rows = []
        for g, i in _parts(slab.group(hot.value, bits)):
            if g in shared and len(i := i[np.isin(prints[i], _unpacked(shared[g]))]):
                at = slab.distinct[i]
                rows.append((g, _ids(slab.owner[at]), _packed(i.astype(np.uint32)), at))
        edges = slab.edges(np.concatenate([r[3] for r in rows]) if rows else np.empty(0, np.int64))
        bounds = np.cumsum([len(r[3]) for r in rows])[:-1]
        labels = [e.tobytes() for e in np.split(edges, bounds)] if rows else []
        return pa.table({"prefix": pa.array([r[0] for r in rows], pa.int64()), "slab": pa.array([key[0].as_py()] * len(rows), pa.int64()),
                         "first": pa.array([r[1] for r in rows], pa.binary()), "places": pa.array([r[2] for r in rows], pa.binary()),
                         "edges": pa.array(labels, pa.binary())})
    return run


def _ids(values: np.ndarray) -> bytes:
    """Document ids in 4 bytes each where all of them fit, else in 8; the first byte says which."""
    kind = np.int32 if not len(values) or (values.min() >= -2 ** 31 and values.max() < 2 ** 31) else np.int64
    return bytes([np.dtype(kind).itemsize]) + values.astype(kind).tobytes()


def _read_ids(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<i{raw[0]}", offset=1).astype(np.int64)


def deep_nodes(edges: np.ndarray) -> np.ndarray:
    """Number of the full-depth node that each suffix of a subtree hangs from.

    The tree is the sorted suffixes with the edges that neighbours share (their
    longest common prefix): an internal node is a run of neighbours sharing at
    least its depth; the deepest share every edge of the window.
    """
    order = np.lexsort(edges.T[::-1])
    common = np.cumprod(edges[order][1:] == edges[order][:-1], axis=1).sum(axis=1)
    node = np.empty(len(order), np.int64)
    node[order] = np.concatenate([[0], np.cumsum(common < edges.shape[1])])
    return node


def _repeats(edge_count: int):
    """Build a prefix group's subtree and tell slabs of earlier documents that have their windows."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slabs, firsts, places, edges = [], [], [], []
        for batch in batches:
            slabs += batch.column("slab").to_pylist()
            firsts += [_read_ids(x) for x in batch.column("first").to_pylist()]
            places += [_unpacked(x) for x in batch.column("places").to_pylist()]
            edges += [np.frombuffer(x, np.uint64).reshape(-1, edge_count) for x in batch.column("edges").to_pylist()]
        owner = np.concatenate(firsts)
        node = deep_nodes(np.concatenate(edges))
        least = np.full(node.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, node, owner)
        least = least[node]
        rows, at = [], 0
        for s, first, place in zip(slabs, firsts, places):
            low = least[at:at + len(place)]
            earlier = low < first
            if earlier.any():
                rows.append((s, _packed(place[earlier]), _ids(low[earlier])))
            at += len(place)
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
                               pa.array([r[2] for r in rows], pa.binary())], ["slab", "places", "least"])
    return run


_DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<start:int,n:int>>"


def _cut(size: int, with_text: bool):
    def run(key, left, right):
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "removed"] + ["kept"] * with_text
        texts = [t for c in left.column("text").chunks for t in as_bytes(c)]
        slab = _Slab(left.column("doc_id").to_pylist(), texts, size)
        least = slab.owner[slab.distinct].copy()
        for place, low in zip(right.column("places").to_pylist(), right.column("least").to_pylist()):
            least[_unpacked(place)] = _read_ids(low)
        covered = least[slab.rank] < slab.owner
        rows, start = [], 0
        for i, text in enumerate(texts):
            n, count = int(slab.lengths[i]), int(slab.counts[i])
            hit = np.zeros(n + 1, np.int64)
            at = np.flatnonzero(covered[start:start + count])
            start += count
            spans = []
            words = text.split() if text else []
            if len(at):
                np.add.at(hit, at, 1)
                np.add.at(hit, at + size, -1)
                gone = np.cumsum(hit)[:n] > 0
                turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                spans = [{"start": int(a), "n": int(b - a)} for a, b in zip(turn[::2], turn[1::2])]
                words = [words[j] for j in np.flatnonzero(~gone)]
            kept = b" ".join(words)
            rows.append((slab.ids[i], n, n - len(words), hashlib.sha256(kept).hexdigest(), spans) + (kept.decode(),) * with_text)
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32())])), pa.string()]
        return pa.table([pa.array([r[j] for r in rows], t) for j, t in zip(range(len(names)), types)], names=names)
    return run


def substring_dedup(docs: DataFrame, *, size: int = 13, slab_chars: int = 8_000_000, cell_suffixes: int = 400_000,
                    with_text: bool = False) -> DataFrame:
    """Find and remove word sequences that an earlier document also has.

    A window is ``size`` consecutive words of a document; each word covered by
    a window that also starts in a document with a smaller doc_id is removed.
    Returns per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed``,
    ``kept_sha256`` of the remaining words, ``removed`` (maximal repeated
    spans, in words) and, on request, the ``kept`` text.

    Suffixes are split by prefixes of variable length: a prefix of one word,
    of two, four, or the whole window, the shortest whose cell holds few
    enough suffixes by counts over all documents.  In a first round a group
    compares 32-bit fingerprints of its suffixes' windows, so that the rest of
    the work is on windows that several slabs of documents seem to have.  In
    the second each group builds the tree of these suffixes, truncated at the
    window; its deepest internal nodes are the repeats and give the smallest
    doc_id.  Consecutive repeated windows join to maximal repeats.  A slab
    sends a window once, however many of its documents have it, so a passage
    of many documents stays small everywhere.

    Null texts have no words; a null doc_id counts as smaller than any other
    and its own text stays.  Rows with one doc_id do not remove each other's words.
    Texts shorter than a window stay whole.  Other columns are not read; an
    empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    context = docs.sparkSession.sparkContext
    chars = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    slabs = max(1, round(chars / slab_chars))
    bits = int(np.clip(np.ceil(np.log2(max(chars / 6 / cell_suffixes, 1))), 4, 18))
    most = max(2 * chars / 6 / (1 << bits), 1)
    hot = np.zeros((len(DEPTHS), 1 << bits), bool)
    summed = docs.mapInArrow(_count_prefixes(size, bits), "depth int, counts binary").groupBy("depth").applyInArrow(_add, "depth int, counts binary")
    for depth, counts in summed.collect():
        hot[depth] = np.frombuffer(counts, np.int64) > most
    hot = context.broadcast(hot)

    # text joins the key so that rows repeating one doc_id are spread as well
    parts = docs.withColumn("slab", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(slabs)))
    by_slab = parts.groupBy("slab")
    prints = by_slab.applyInArrow(_emit_prints(size, bits, hot), "prefix long, slab long, prints binary")
    shared = materialize(prints.groupBy("prefix").applyInArrow(_shared_prints, "slab long, prefix long, prints binary"))
    suffixes = by_slab.cogroup(shared.groupBy("slab")).applyInArrow(
        _emit_suffixes(size, bits, hot), "prefix long, slab long, first binary, places binary, edges binary")
    repeats = materialize(suffixes.groupBy("prefix").applyInArrow(_repeats(-(-size // EDGE)), "slab long, places binary, least binary"))
    return by_slab.cogroup(repeats.groupBy("slab")).applyInArrow(
        _cut(size, with_text), _DIGEST + ", kept string" * with_text)
