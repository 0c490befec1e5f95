"""SentencePiece encoding and decoding: distinct sampled segmentations by Gumbel top-k search of the lattice."""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import mixed

SPACE = "▁"
#: No piece reaches over the end of one of these.
_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)
_SLOT_BITS = 20
#: Segments that are looked up at a time, and those kept from one time to the next.
_TOKENS, _KEPT = 60_000, 30_000


class Vocabulary:
    """Pieces of a model file, their log probabilities, and a trie of hashed prefixes."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.bytes = {}
        usable = {}
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                usable[piece] = i
        for piece in usable:
            if "\n" in piece[1:] or SPACE in piece.lstrip(SPACE):
                raise ValueError(f"piece {piece!r} reaches over the end of a segment")
        # the scores of merge models are ranks, not probabilities: take them as the ranks of a Zipf law
        first = min(usable.values())
        rank = np.where(np.arange(n) >= first, np.arange(n) - first, n)
        weight = -np.log(rank + 2.0)
        self.log_p = weight - np.log(np.exp(weight).sum())
        self.byte_ids = np.array([self.bytes.get(b, -1) for b in range(256)], np.int64)
        prefixes = {p[:i] for p in usable for i in range(1, len(p) + 1)}
        keys = np.array([_hash(p) for p in prefixes], np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        if len(np.unique(keys)) < len(keys):
            raise ValueError("prefix hashes collide")
        self.ids = np.array([usable.get(p, -1) for p in prefixes], np.int64)[order]
        # the place of each key by its own slot in the first of a few tables where it is free
        self.slots, left = [], np.arange(len(self.keys))
        while len(left):
            slot = _slot(self.keys[left], len(self.slots))
            table = np.full(1 << _SLOT_BITS, -1, np.int32)
            table[slot[::-1]] = left[::-1]
            self.slots.append(table)
            left = left[table[slot] != left]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash among the keys, -1 if it is none of them."""
        out = self.slots[0][_slot(hashes, 0)]
        open_ = np.flatnonzero((out >= 0) & (self.keys[out] != hashes))
        out[open_] = -1
        for k, table in enumerate(self.slots[1:], 1):
            found = table[_slot(hashes[open_], k)]
            hit = (found >= 0) & (self.keys[found] == hashes[open_])
            out[open_[hit]] = found[hit]
            open_ = open_[~hit & (found >= 0)]
        return out


def _slot(hashes: np.ndarray, table: int) -> np.ndarray:
    return ((hashes ^ (hashes >> np.uint64(29))) * (_ODD + np.uint64(2 * table)) >> np.uint64(64 - _SLOT_BITS)).view(np.int64)


def _hash(text: str) -> int:
    h = 0
    for c in text:
        h = (h * int(_BASE) + ord(c) + 1) % 2 ** 64
    return h


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lattice:
    """Edges of many segments' lattices, in order of their start node; nodes are the places between characters."""

    def __init__(self, segments: list[str], vocab: Vocabulary, alpha: float):
        codes = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        n_nodes = int((sizes + 1).sum())
        self.start = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)
        stop = self.start + sizes
        at = np.arange(len(codes)) + np.repeat(np.arange(len(segments)), sizes)  # each character's node
        last = np.repeat(stop, sizes)
        char_of = np.zeros(n_nodes, np.int64)
        char_of[at] = np.arange(len(codes))
        # edges of each node by length: found by length, written behind those of the lengths before
        src, rank, size, ids = [], [], [], []
        counts = np.zeros(n_nodes, np.int64)
        here, hashes, length = at, np.zeros(len(at), np.uint64), 0
        while len(here):
            hashes = hashes * _BASE + codes[char_of[here] + length] + np.uint64(1)
            length += 1
            found = vocab.find(hashes)
            ok = np.flatnonzero(found >= 0)
            here, hashes, found = here[ok], hashes[ok], vocab.ids[found[ok]]
            piece = np.flatnonzero(found >= 0)
            src.append(here[piece])
            ids.append(found[piece])
            if length == 1:  # characters that are no piece: their UTF-8 bytes as one edge, kept as -1 - code point
                single = np.zeros(n_nodes, bool)
                single[src[0]] = True
                lost = at[~single[at]]
                code = codes[char_of[lost]].astype(np.int64)
                src[0] = np.concatenate([src[0], lost])
                ids[0] = np.concatenate([ids[0], np.where(code < 128, vocab.byte_ids[np.minimum(code, 127)], -1 - code)])
            rank.append(counts[src[-1]])
            size.append(np.full(len(src[-1]), length))
            counts[src[-1]] += 1
            more = here + length < last[char_of[here]]
            here, hashes = here[more], hashes[more]
        first = np.concatenate([[0], np.cumsum(counts)])
        some = np.concatenate([np.empty(0, np.int64), *src])
        place = first[some] + np.concatenate([np.empty(0, np.int64), *rank])
        src, self.dst, self.ids = np.empty(len(some), np.int64), np.empty(len(some), np.int64), np.empty(len(some), np.int64)
        src[place], self.dst[place] = some, some + np.concatenate([np.empty(0, np.int64), *size])
        self.ids[place] = np.concatenate([np.empty(0, np.int64), *ids])
        weight = alpha * np.where(self.ids >= 0, vocab.log_p[np.maximum(self.ids, 0)], 0.0)
        for i in np.flatnonzero(self.ids < 0):
            weight[i] = alpha * sum(vocab.log_p[vocab.bytes[b]] for b in _utf8(-1 - self.ids[i]))
        total = np.zeros(n_nodes)
        left = np.zeros(n_nodes, np.int64)
        left[at] = last - at
        by_left = np.argsort(left[at].astype(np.min_scalar_type(left.max(initial=0))), kind="stable")
        nodes, bounds = at[by_left], np.searchsorted(left[at][by_left], np.arange(1, left.max(initial=0) + 2))
        for a, b in zip(bounds, bounds[1:]):  # from the ends backward, all segments at once
            some = nodes[a:b]
            counts = first[some + 1] - first[some]
            offset = np.cumsum(counts) - counts
            edges = np.repeat(first[some] - offset, counts) + np.arange(counts.sum())
            value = weight[edges] + total[self.dst[edges]]
            top = np.maximum.reduceat(value, offset)
            total[some] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, counts)), offset))
        self.p = np.exp(weight + total[self.dst] - total[src])
        self.src, self.n_nodes = src, n_nodes
        self.final = np.zeros(n_nodes, bool)
        self.final[stop] = True
        # running probability within each node, all nodes on one line; and each node's likeliest edge
        counts = np.diff(first)
        some = np.flatnonzero(counts)
        ends = np.cumsum(self.p)
        before = np.repeat((ends - self.p)[first[some]], counts[some])
        self.before = np.maximum(ends - self.p - before, 0.0)
        self.line = src + np.minimum(ends - before, 1.0)
        self.line[first[some + 1] - 1] = some + 1.0
        self.likely, self.likely_p = np.zeros(n_nodes, np.int64), np.zeros(n_nodes)
        if len(some):
            top = np.repeat(np.maximum.reduceat(self.p, first[some]), counts[some])
            at_top = np.flatnonzero(self.p == top)
            self.likely[src[at_top[::-1]]] = at_top[::-1]
            self.likely_p[some] = self.p[self.likely[some]]
        # the probability beside each edge: a likely edge's is the sum of the others, as 1 - p would lose its digits
        self.rest = np.maximum(1 - self.p, 0.0)
        if len(some):
            others = self.p.copy()
            others[self.likely[some]] = 0.0
            self.rest[self.likely[some]] = np.add.reduceat(others, first[some])
        with np.errstate(divide="ignore"):
            self.log_p = np.log(self.p)

    @staticmethod
    def joined(parts: list[Lattice]) -> Lattice:
        """One lattice of several."""
        out = object.__new__(Lattice)
        nodes = np.cumsum([0] + [p.n_nodes for p in parts])
        edges = np.cumsum([0] + [len(p.src) for p in parts])
        for name in ("start", "dst", "src", "line"):
            setattr(out, name, np.concatenate([getattr(p, name) + s for p, s in zip(parts, nodes)]))
        out.likely = np.concatenate([p.likely + s for p, s in zip(parts, edges)])
        for name in ("ids", "p", "log_p", "rest", "final", "before", "likely_p"):
            setattr(out, name, np.concatenate([getattr(p, name) for p in parts]))
        out.n_nodes = int(nodes[-1])
        return out

    def search(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge of each node in which ``u`` in [0, 1) falls, edges in order."""
        return np.searchsorted(self.line, node + np.minimum(u, 1 - 1e-9), "right")

    def draw(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The same with the likeliest edge first, which most draws take."""
        out, p = self.likely[node], self.likely_p[node]
        rest = np.flatnonzero(u >= p)
        u, best = u[rest] - p[rest], out[rest]
        u = np.where(u >= self.before[best], u + p[rest], u)
        found = self.search(node[rest], u)
        # rounding may leave u at the rim of the likeliest edge: then it is that edge
        out[rest] = np.where(self.src[np.minimum(found, len(self.src) - 1)] == node[rest], np.minimum(found, len(self.src) - 1), best)
        return out


def _utf8(code: int) -> bytes:
    return chr(code).encode("utf-8", "surrogatepass")


def _uniform(seed: np.ndarray, *parts) -> np.ndarray:
    x = seed
    for i, part in enumerate(parts):
        x = mixed((x ^ (np.asarray(part).astype(np.uint64) + np.uint64(i + 1))) * _ODD)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


class _Paths:
    """One segmentation of each row: its edges in order, and the score of what stands beside each step."""

    def __init__(self, lattice, rows, tokens, segment, seed, sample, bound, begin=None):
        """Sample the ``tokens`` (with their ``rows``) freely; ``begin``: the nodes where some start."""
        node = lattice.start[segment] if begin is None else begin
        live, step = np.flatnonzero(~lattice.final[node]), 0
        who, edges, steps = [], [], []
        while len(live):
            u = _uniform(seed[rows[live]], tokens[live], np.full(len(live), step), np.full(len(live), sample))
            e = lattice.draw(node[live], u)
            who.append(live)
            edges.append(e)
            steps.append(np.full(len(live), step))
            node[live] = lattice.dst[e]
            live, step = live[~lattice.final[node[live]]], step + 1
        who, edges, steps = (np.concatenate([np.empty(0, np.int64), *x]) for x in (who, edges, steps))
        counts = np.bincount(who, minlength=len(rows))
        place = (np.cumsum(counts) - counts)[who] + steps
        self.edges, self.token = np.empty(len(edges), np.int64), np.empty(len(edges), np.int64)
        self.edges[place], self.token[place] = edges, who


def _sampled(lattice: Lattice, rows: np.ndarray, segment: np.ndarray, seed: np.ndarray, k: int):
    """Top-k of the Gumbel-perturbed segmentations of each row, best first.

    The search runs over sets of segmentations, each with the largest
    perturbed log probability in it.  Following a path splits a set at every
    step into the part that goes on and the rest beside it; the path's own
    value is the set's, and a rest's value is a Gumbel variable truncated
    there.  The next segmentation lies in the rest with the largest value.
    Returns ``(paths, log_p, score)`` with a list of ``(row of each step,
    edges)``; ``score`` has a column more, for what is left after k.
    """
    n = len(seed)
    token = np.arange(len(rows)) - np.searchsorted(rows, rows)
    bound = -np.log(-np.log(_uniform(seed, np.zeros(n), np.zeros(n), np.full(n, 77))))
    paths, log_p, scores = [], [], [bound]
    open_rest, steps_before, excluded = [], [], []
    free = _Paths(lattice, rows, token, segment, seed, 0, bound)
    row, edges, tokens = rows[free.token], free.edges, token[free.token]
    fresh = np.ones(len(edges), bool)
    special = np.full(len(edges), False)
    out_mass = np.zeros(len(edges))
    for sample in range(k):
        size = np.bincount(row, minlength=n)
        begin = np.cumsum(size) - size
        step_log = lattice.log_p[edges]
        run = np.cumsum(step_log)
        base = np.where(size > 0, np.append(run, 0.0)[np.minimum(begin, len(run))] - np.append(step_log, 0.0)[np.minimum(begin, len(run))], 0.0)
        before = run - step_log - base[row]
        log_p.append(np.bincount(row, step_log, minlength=n))
        beside = np.where(special, out_mass, lattice.rest[edges])
        noise = -np.log(_uniform(seed[row], tokens, np.arange(len(row)) - begin[row], np.full(len(row), 1000 + sample)))
        with np.errstate(divide="ignore"):
            value = -np.logaddexp(-scores[sample][row], np.log(noise / beside) - before)
        value = np.where(fresh & (beside > 0), value, -np.inf)
        paths.append((row, edges, tokens, begin, size))
        open_rest.append(value)
        excluded.append((special, out_mass))
        # the best rest of each row over all its paths
        best, which, where = np.full(n, -np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for q, (qrow, _, _, qbegin, qsize) in enumerate(paths):
            some = np.flatnonzero(qsize)
            if not len(some):
                continue
            top = np.full(n, -np.inf)
            top[some] = np.maximum.reduceat(open_rest[q], qbegin[some])
            at = np.flatnonzero((open_rest[q] == top[qrow]) & np.isfinite(open_rest[q]))
            spot = np.zeros(n, np.int64)
            spot[qrow[at[::-1]]] = at[::-1]
            better = top > best
            best, which, where = np.where(better, top, best), np.where(better, q, which), np.where(better, spot, where)
        scores.append(best)
        if sample == k - 1:
            break
        # follow the best rests
        parts = {name: [] for name in ("row", "edges", "tokens", "fresh", "special", "mass")}
        for q, (qrow, qedges, qtokens, qbegin, qsize) in enumerate(paths):
            chosen = np.flatnonzero(np.isfinite(best) & (which == q))
            if not len(chosen):
                continue
            at = where[chosen]
            open_rest[q][at] = -np.inf
            node, avoid = lattice.src[qedges[at]], [qedges[at]]
            # edges taken before at this very place
            for r in range(len(paths)):
                if r != q:
                    rrow, redges, _, rbegin, rsize = paths[r]
                    offset = at - qbegin[chosen]
                    has = offset < rsize[chosen]
                    spot = np.where(has, rbegin[chosen] + offset, 0)
                    same = has & _same_way(lattice, paths[q], paths[r], chosen, offset)
                    avoid.append(np.where(same, redges[spot] if len(redges) else 0, -1))
            e, beyond = _another(lattice, node, np.stack(avoid), seed[chosen], at - qbegin[chosen], sample)
            # the kept beginning
            length = at - qbegin[chosen]
            head = np.repeat(qbegin[chosen] - (np.cumsum(length) - length), length) + np.arange(length.sum())
            # what follows is free: the rest of the token, then all later tokens
            first_token = np.searchsorted(rows, chosen)
            n_tokens = np.searchsorted(rows, chosen, "right") - first_token
            now = qtokens[at]
            count = n_tokens - now
            pick = np.repeat(first_token + now - (np.cumsum(count) - count), count) + np.arange(count.sum())
            begin_nodes = lattice.start[segment[pick]]
            begin_nodes[np.cumsum(count) - count] = lattice.dst[e]
            tail = _Paths(lattice, rows[pick], token[pick] + 1, segment[pick], seed, sample + 1, best, begin_nodes)
            for name, head_value, mid_value, tail_value in (
                    ("row", qrow[head], chosen, rows[pick][tail.token]), ("edges", qedges[head], e, tail.edges),
                    ("tokens", qtokens[head], now, token[pick][tail.token]),
                    ("fresh", np.zeros(len(head), bool), np.ones(len(e), bool), np.ones(len(tail.edges), bool)),
                    ("special", np.zeros(len(head), bool), np.ones(len(e), bool), np.zeros(len(tail.edges), bool)),
                    ("mass", np.zeros(len(head)), beyond, np.zeros(len(tail.edges)))):
                parts[name] += [head_value, mid_value, tail_value]
        joined = {name: np.concatenate(v) if v else np.empty(0) for name, v in parts.items()}
        order = np.argsort(joined["row"], kind="stable")
        row, edges, tokens = (joined[c][order].astype(np.int64) for c in ("row", "edges", "tokens"))
        fresh, special, out_mass = joined["fresh"][order].astype(bool), joined["special"][order].astype(bool), joined["mass"][order]
    return paths, np.stack(log_p, axis=1), np.stack(scores, axis=1)


def _another(lattice, node, avoid, seed, offset, sample):
    """An edge of each node but those to avoid, in proportion to their probabilities, and what is left beside it.

    The edge has the largest Gumbel-perturbed log probability, so edges of any
    probability above 0 can be drawn and none is lost to rounding.
    """
    first, stop = np.searchsorted(lattice.src, node), np.searchsorted(lattice.src, node, "right")
    counts = stop - first
    begin = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(node)), counts)
    edges = np.arange(counts.sum()) - begin[owner] + first[owner]
    weight = lattice.p[edges]
    for taken in avoid:
        some = np.flatnonzero(taken >= 0)
        weight[begin[some] + taken[some] - first[some]] = 0.0
    noise = -np.log(-np.log(_uniform(seed[owner], offset[owner], edges - first[owner], np.full(len(edges), 2000 + sample))))
    with np.errstate(divide="ignore"):
        value = np.log(weight) + noise
    at = np.flatnonzero(value == np.maximum.reduceat(value, begin)[owner])
    pick = np.empty(len(node), np.int64)
    pick[owner[at[::-1]]] = at[::-1]
    weight[pick] = 0.0
    return edges[pick], np.add.reduceat(weight, begin)


def _same_way(lattice, a, b, chosen, offset):
    """Whether both paths have the same edges before ``offset`` in the chosen rows."""
    same = np.zeros(len(chosen), bool)
    for i, (c, o) in enumerate(zip(chosen.tolist(), offset.tolist())):
        x, y = a[3][c], b[3][c]
        same[i] = b[4][c] >= o and np.array_equal(a[1][x:x + o], b[1][y:y + o])
    return same


def _segments(text: str) -> list[str]:
    return _SEGMENT.findall(SPACE + text.replace(" ", SPACE)) if text else []


def _expand(ids: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Byte pieces in place of characters that are no piece."""
    odd = np.flatnonzero(ids < 0)
    if not len(odd):
        return ids.astype("<i4")
    raw = [vocab.byte_ids[list(_utf8(-1 - i))] for i in ids[odd].tolist()]
    counts = np.ones(len(ids), np.int64)
    counts[odd] = [len(r) for r in raw]
    out = np.repeat(ids, counts)
    out[np.repeat(ids < 0, counts)] = np.concatenate(raw)
    return out.astype("<i4")


def _encode(path: str, k: int, alpha: float, salt: int):
    def run(batches):
        vocab = vocabulary(path)
        kept: dict[str, int] = {}
        kept_lattice = None
        for batch in batches:
            texts, ids = batch.column("text"), batch.column("doc_id").to_pylist()
            at = 0
            while at < len(texts):
                rows, segment, known, count = [], [], defaultdict(itertools.count(len(kept)).__next__, kept), 0
                begin = at
                while at < len(texts) and (count < _TOKENS or at == begin):
                    parts = _segments(texts[at].as_py() or "")
                    segment.append(np.fromiter(map(known.__getitem__, parts), np.int64, len(parts)))
                    rows.append(len(parts))
                    count += len(parts)
                    at += 1
                new = list(known)[len(kept):]
                parts = [x for x in (kept_lattice, Lattice(new, vocab, alpha) if new else None) if x is not None]
                segment = np.concatenate(segment)
                if kept_lattice is None and new:
                    often = np.argsort(-np.bincount(segment, minlength=len(known)), kind="stable")[:_KEPT]
                    names = list(known)
                    kept = {names[i]: j for j, i in enumerate(often)}
                    kept_lattice = Lattice(list(kept), vocab, alpha)
                seed = np.array([xxhash.xxh3_64_intdigest(b"" if i is None else b"%d" % i, salt) for i in ids[begin:at]], np.uint64)
                yield _rows(Lattice.joined(parts) if parts else None, np.repeat(np.arange(at - begin), rows), segment, seed, k,
                            ids[begin:at], vocab)
    return run


def _rows(lattice, rows, segment, seed, k, ids, vocab):
    out = [[] for _ in range(6)]
    if lattice is None:
        paths, log_p, scores = [], np.zeros((len(ids), 0)), np.zeros((len(ids), 1))
    else:
        paths, log_p, scores = _sampled(lattice, rows, segment, seed, k)
    empty = np.bincount(rows, minlength=len(ids)) == 0
    last = scores[:, -1]
    for j in range(k):
        for i in range(len(ids)):
            if empty[i]:
                if j == 0:
                    values = (ids[i], 1, 0, 0.0, 0.0, b"")
                else:
                    continue
            elif not np.isfinite(scores[i, j]):
                continue
            else:
                _, edges, _, begin, size = paths[j]
                pieces = _expand(lattice.ids[edges[begin[i]:begin[i] + size[i]]], vocab)
                x = log_p[i, j] - last[i]
                included = 0.0 if x > 3 or not np.isfinite(last[i]) else x if x < -30 else float(np.log(-np.expm1(-np.exp(x))))
                values = (ids[i], j + 1, len(pieces), float(log_p[i, j]), included, pieces.tobytes())
            for column, v in zip(out, values):
                column.append(v)
    types = (pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
    return pa.record_batch([pa.array(c, t) for c, t in zip(out, types)],
                           ["doc_id", "sample", "n_pieces", "log_prob", "log_inclusion", "piece_ids"])


def encode_samples(docs: DataFrame, model: str, *, k: int = 2, alpha: float = 1.0, salt: int = 0) -> DataFrame:
    """``k`` distinct segmentations of every text, drawn without replacement.

    Segmentations are sampled in proportion to the product of their pieces'
    probabilities to the power ``alpha``.  Returns a row per row of ``docs``
    and sample: ``doc_id``, ``sample`` (1 is the largest perturbed score),
    ``n_pieces``, ``log_prob``, ``log_inclusion`` (log of the chance to be
    among the k, given the score of what was left out) and ``piece_ids``
    (32-bit little-endian).  ``model`` is the path of a model file that every
    executor can read.

    No segmentation is left out, however unlikely.  Spaces are part of pieces and a text starts with one; characters that are
    no piece become their bytes.  The random numbers depend on doc_id and
    ``salt`` alone, so repeated rows have equal samples.  A null or empty text
    has one segmentation without pieces; a text with fewer than ``k``
    segmentations has as many rows as it has.  Other columns are not read; an
    empty table gives no rows.  Nothing is shuffled.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(_encode(model, k, alpha, salt), "doc_id long, sample int, n_pieces long, log_prob double, log_inclusion double, piece_ids binary")


def decode_ids(ids: np.ndarray, vocab: Vocabulary) -> str:
    """The text of a sequence of pieces."""
    byte = {i: b for b, i in vocab.bytes.items()}
    raw = b"".join(bytes([byte[i]]) if i in byte else vocab.pieces[i].encode() for i in ids.tolist())
    return raw.decode("utf-8", "replace").replace(SPACE, " ")[1:]


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with the ``text`` of its ``piece_ids``; null stays null, and a column ``text`` is replaced."""
    columns = [c for c in encoded.columns if c != "text"]

    def run(batches):
        vocab = vocabulary(model)
        for batch in batches:
            text = [None if x is None else decode_ids(np.frombuffer(x, "<i4"), vocab) for x in batch.column("piece_ids").to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(text, pa.string())], [*columns, "text"])
    schema = encoded.select(*columns).schema.add("text", "string")
    return encoded.select(*columns).mapInArrow(run, schema)
