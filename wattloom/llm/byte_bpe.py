"""Byte-level BPE: texts cut into overlapping chunks, stitched where pre-tokens resynchronise, pieces merged by rank.

A text longer than ``chunk`` characters becomes chunks that reach ``overlap``
characters into their successor and are dealt over the tasks.  Each is cut
into pre-tokens from its own first character, so its first ones may be wrong,
and those at its end are not settled.  A pre-token depends on the text from
its start on alone: at the first boundary that a chunk and its predecessor
share in the overlap both have the same pre-tokens from there on.  Chunks that
share none with their predecessor (a run of one kind of character longer than
the overlap) are joined to it and cut again, until every chunk has such a
boundary.  So the pre-tokens are those of the whole text.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wattloom.session import discard, materialize

#: The split pattern of the rank files; another may be given.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: A pre-token is settled once so many characters after its start are known (the longest contraction).
_SIGHT = 3
#: Pieces whose ids a worker remembers, most bytes of a piece merged beside others, rows of a text column taken at a time.
_KEPT, _SHORT, _ROWS = 100_000, 64, 256
_NEVER = 1 << 62


def read_ranks(path: str) -> bytes:
    """The rank file as it is; the driver reads it and ships it with the job."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines()) if token}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the neighbours whose union has the lowest rank are joined first, the leftmost of equals.

    The open joins stand in a heap, so a piece of n bytes takes n log n steps.
    Every single byte must have a rank.
    """
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    stop = list(range(1, n + 1))  # where the part that starts here ends; 0 once it is joined to the one before
    before = list(range(-1, n - 1))
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        middle = stop[i]
        if not middle or middle >= n or stop[middle] != end:
            continue  # one of the two parts has grown since
        stop[i], stop[middle] = end, 0
        if end < n:
            before[end] = i
            if (rank := ranks.get(piece[i:stop[end]])) is not None:
                heapq.heappush(heap, (rank, i, stop[end]))
        if (left := before[i]) >= 0 and (rank := ranks.get(piece[left:end])) is not None:
            heapq.heappush(heap, (rank, left, end))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:stop[i]]])
        i = stop[i]
    return ids


class _Pieces:
    """Ids of pieces; those of one call that are not known yet are merged side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.known = ranks, {}
        self.byte = np.array([ranks[bytes([i])] for i in range(256)])
        joins = [(a << 32 | b, rank) for token, rank in ranks.items() for i in range(1, len(token))
                 if (a := ranks.get(token[:i])) is not None and (b := ranks.get(token[i:])) is not None]
        self.pairs, self.joined = np.array(sorted(joins) or [(-1, _NEVER)], np.int64).T.copy()

    def encode(self, rows: list[list[str]]) -> list[np.ndarray]:
        """Ids of each row of pieces."""
        wanted = set().union(*rows)
        if len(self.known) + len(wanted) > _KEPT:
            self.known = {}
        new = list(wanted.difference(self.known))
        self.known |= zip(new, self._merged([piece.encode() for piece in new]))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, row)), "<i4") for row in rows]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the union of two tokens, which is its id."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.joined[at], _NEVER)

    def _merged(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each piece: a round joins one pair in every short piece that has one left."""
        out = [b""] * len(pieces)
        short = []
        for i, piece in enumerate(pieces):
            if len(piece) > _SHORT or piece in self.ranks:
                out[i] = np.array(merge(piece, self.ranks), "<i4").tobytes()
            else:
                short.append(i)
        ids = self.byte[np.frombuffer(b"".join(pieces[i] for i in short), np.uint8)]
        piece = np.repeat(np.arange(len(short)), [len(pieces[i]) for i in short])
        join = np.full(len(ids), _NEVER)  # rank of a token's union with the next one of its piece
        join[:-1][piece[1:] == piece[:-1]] = 0
        join[join == 0] = self._rank(ids[:-1], ids[1:])[join[:-1] == 0]
        while len(ids):
            begin = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
            size = np.diff(np.r_[begin, len(ids)])
            low = np.minimum.reduceat(join, begin)
            done = low == _NEVER
            if done.any():
                packed = ids[np.repeat(done, size)].astype("<i4").tobytes()
                stop = np.cumsum(size[done]).tolist()
                for i, a, b in zip(piece[begin[done]].tolist(), [0, *stop], stop):
                    out[short[i]] = packed[4 * a:4 * b]
                rest = ~np.repeat(done, size)
                ids, piece, join, low, size = ids[rest], piece[rest], join[rest], low[~done], size[~done]
                if not len(ids):
                    break
            lowest = np.flatnonzero(join == np.repeat(low, size))
            at = lowest[np.r_[True, piece[lowest[1:]] != piece[lowest[:-1]]]]  # the leftmost of each piece
            ids[at] = low
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            ids, piece, join = ids[stay], piece[stay], join[stay]
            at -= np.arange(len(at))
            inner = at[(at + 1 < len(ids)) & (piece[np.minimum(at + 1, len(ids) - 1)] == piece[at])]
            join[at] = _NEVER
            join[inner] = self._rank(ids[inner], ids[inner + 1])
            inner = at[(at > 0) & (piece[at - 1] == piece[at])]
            join[inner - 1] = self._rank(ids[inner - 1], ids[inner])
        return out


@lru_cache(maxsize=2)
def _pieces(raw: bytes) -> _Pieces:
    """One memory of pieces for all tasks that a worker runs."""
    return _Pieces(parse_ranks(raw))


@lru_cache(maxsize=2)
def _tokens(raw: bytes) -> list[bytes]:
    ranks = parse_ranks(raw)
    out = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def _slices(batches):
    for batch in batches:
        for a in range(0, max(len(batch), 1), _ROWS):
            yield batch.slice(a, _ROWS)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(x) for x in rows], out=offsets[1:])
    values = np.concatenate(rows) if rows else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def _encode_whole(raw, pattern: str):
    """Column function: ids of each text, cut into pre-tokens in one go."""
    @F.arrow_udf(T.ArrayType(T.IntegerType(), False))
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        split, pieces = regex.compile(pattern).findall, _pieces(raw.value)
        for batch in _slices(texts):
            yield _lists(pieces.encode(list(map(split, batch.to_pylist()))))
    return run


def boundaries(text: str, pattern) -> list[int]:
    """Ends of the pre-tokens of ``text``, from its first character on."""
    return [m.end() for m in pattern.finditer(text)]


def _settled(ends: list[int], length: int, last: bool) -> list[int]:
    """The boundaries that stay whatever follows the chunk."""
    if last:
        return ends
    out, start = [], 0
    for end in ends:
        if end >= length or start + _SIGHT > length:
            break
        out.append(end)
        start = end
    return out


_CUT = "key binary, start long, stop long, last boolean, chunk string, ends binary, head array<int>, tail array<int>"


def _chunks(size: int, overlap: int):
    def run(batches):
        schema = pa.schema([("key", pa.binary()), ("start", pa.int64()), ("stop", pa.int64()), ("last", pa.bool_()), ("chunk", pa.string())])
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                for low in range(0, len(text), 64 * size):
                    rows = [(key, a, min(a + size, len(text)), a + size >= len(text), text[a:a + size + overlap])
                            for a in range(low, min(low + 64 * size, len(text)), size)]
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    return run


def _cut(pattern: str, overlap: int):
    """Pre-token ends of chunks, those near its start (``head``) and those past ``stop`` (``tail``)."""
    def run(batches):
        split = regex.compile(pattern)
        for batch in batches:
            ends, heads, tails = [], [], []
            size = (np.array(batch.column("stop")) - np.array(batch.column("start"))).tolist()
            for text, n, last in zip(batch.column("chunk").to_pylist(), size, batch.column("last").to_pylist()):
                own = _settled(boundaries(text, split), len(text), last)
                ends.append(np.array(own, "<i4").tobytes())
                heads.append([0] + [e for e in own if e <= overlap])
                tails.append([] if last else [e - n for e in own if e >= n])
            columns = [batch.column(c) for c in ("key", "start", "stop", "last", "chunk")]
            yield pa.record_batch([*columns, pa.array(ends, pa.binary()), pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))],
                                  ["key", "start", "stop", "last", "chunk", "ends", "head", "tail"])
    return run


def _with_entries(chunks: DataFrame) -> DataFrame:
    """Adds ``entry``: the first boundary that a chunk shares with its predecessor, null if there is none."""
    before = chunks.where("not last").select("key", F.col("stop").alias("start"), F.col("tail").alias("before"))
    shared = F.array_min(F.array_intersect("head", "before"))
    return chunks.join(before, ["key", "start"], "left").withColumn("entry", F.when(F.col("start") == 0, F.lit(0)).otherwise(shared)).drop("before")


def _joined(chunks: DataFrame) -> DataFrame:
    """Every chunk without an entry joined to its predecessor."""
    group = F.count("entry").over(Window.partitionBy("key").orderBy("start"))
    own = F.struct("start", "stop", F.col("chunk").alias("chunk"))
    runs = chunks.withColumn("run", group).groupBy("key", "run").agg(
        F.array_sort(F.collect_list(own)).alias("parts"), F.min("start").alias("start"), F.max("stop").alias("stop"), F.max("last").alias("last"))
    text = F.expr("array_join(transform(parts, (p, i) -> if(i = size(parts) - 1, p.chunk, left(p.chunk, cast(p.stop - p.start as int)))), '')")
    return runs.select("key", "start", "stop", "last", text.alias("chunk"))


def _encode_chunks(raw):
    def run(batches):
        pieces = _pieces(raw.value)
        for batch in batches:
            ids = []
            for text, ends, entry, leave in zip(*(batch.column(c).to_pylist() for c in ("chunk", "ends", "entry", "leave"))):
                at = np.frombuffer(ends, "<i4")
                at = at[(at > entry) & (at <= leave)].tolist()
                ids += pieces.encode([[text[a:b] for a, b in zip([entry, *at], at)]])
            yield pa.record_batch([batch.column("key"), batch.column("start"), _lists(ids)], ["key", "start", "ids"])
    return run


def _encode_long(long: DataFrame, raw, pattern: str, chunk: int, overlap: int) -> tuple[DataFrame, list[DataFrame]]:
    """``(key, ids)`` of the texts ``(key, text)``, copies once, and the written tables it reads."""
    rows = long.mapInArrow(_chunks(chunk, overlap), "key binary, start long, stop long, last boolean, chunk string")
    rows = rows.groupBy("key", "start").agg(*[F.first(c).alias(c) for c in ("stop", "last", "chunk")])
    cut = lambda df: materialize(df.mapInArrow(_cut(pattern, overlap), _CUT))
    done, written = cut(rows), []
    while True:
        written.append(done)
        # every chunk's entry and that of the chunk after it, where it stops
        entries = materialize(_with_entries(done.drop("chunk", "ends")).select("key", "start", "entry"))
        written.append(entries)
        if entries.where("entry is null").isEmpty():
            break
        open_keys = entries.where("entry is null").select("key").distinct()
        entries = done.join(entries, ["key", "start"])
        joined = cut(_joined(entries.join(open_keys, "key", "left_semi")))
        done = materialize(done.join(open_keys, "key", "left_anti").unionByName(joined))
        written.append(joined)
    after = entries.select("key", F.col("start").alias("stop"), F.col("entry").alias("after"))
    placed = done.join(entries, ["key", "start"]).join(after, ["key", "stop"], "left")
    leave = F.when(F.col("last"), F.char_length("chunk")).otherwise((F.col("stop") - F.col("start")).cast("int") + F.col("after"))
    placed = placed.select("key", "start", "chunk", "ends", "entry", leave.alias("leave"))
    ids = placed.mapInArrow(_encode_chunks(raw), "key binary, start long, ids array<int>")
    parts = F.array_sort(F.collect_list(F.struct("start", "ids")))
    return ids.groupBy("key").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids")), written


def encode(docs: DataFrame, ranks: str, *, pattern: str = PATTERN, chunk: int = 32_768, overlap: int = 1_024) -> DataFrame:
    """``docs`` with ``ids``: the token ids of ``text`` (any other column ``ids`` is replaced).

    Texts up to ``chunk`` characters are cut into pre-tokens whole, longer
    ones in overlapping chunks that are stitched (see above).  Pieces are
    merged by the ranks of the file ``ranks``, whose bytes go with the job, so
    only the driver reads it.  No special tokens.

    A null text has the ids of an empty one: none.  Repeated rows stay; long
    texts that are equal are encoded once.  An empty table gives none, and
    other columns, whatever their names, stay as they are.  Chunks are shuffled
    once, short texts not at all.  A text's ids return to one row, as its text
    was one row; no pre-token is ever split.
    """
    spark = docs.sparkSession
    raw = spark.sparkContext.broadcast(read_ranks(ranks))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = [F.col(f"`{c}`") for c in docs.columns if c != "ids"]
    rows = docs.select(F.struct(*own).alias("row"), text.alias("text"))
    short = rows.where(F.char_length("text") <= chunk).select("row.*", _encode_whole(raw, pattern)("text").alias("ids"))
    long = rows.where(F.char_length("text") > chunk).withColumn("key", F.unhex(F.sha2("text", 256)))
    found, written = _encode_long(long.select("key", "text"), raw, pattern, chunk, overlap)
    found = materialize(found)
    discard(*written)
    return short.unionByName(long.drop("text").join(found, "key").select("row.*", "ids"))


def decode_bytes(ids: Column, spark: SparkSession, ranks: str) -> Column:
    """The bytes of an array of token ids, one after the other; null stays null."""
    raw = spark.sparkContext.broadcast(read_ranks(ranks))

    @F.arrow_udf(T.BinaryType())
    def run(rows: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = _tokens(raw.value).__getitem__
        for batch in _slices(rows):
            offsets, values, present = batch.offsets.to_pylist(), np.array(batch.values), batch.is_valid().to_pylist()
            yield pa.array([b"".join(map(token, values[a:b].tolist())) if p else None
                            for a, b, p in zip(offsets, offsets[1:], present)], pa.binary())
    return run(ids)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of its ``ids`` (a column of that name is replaced)."""
    return encoded.withColumn("decoded", decode_bytes(F.col("ids"), encoded.sparkSession, ranks))
