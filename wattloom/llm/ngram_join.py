"""N-gram Jaccard join: components of documents whose shingle sets are alike, by a grouped prefix join."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import as_bytes, mixed, window_hashes, word_hashes
from wattloom.llm.linking import linked
from wattloom.session import discard, materialize

#: Counters of the frequency sketch; fixed, so its size does not follow the input.
SLOTS = 1 << 20
_BLOCKS = 16


def shingle_set(raw: bytes | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct ``size``-word shingles of a text (A-Z lower-cased)."""
    words = raw.lower().split() if raw else []
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(word_hashes(words), min(size, len(words))))


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(44)).astype(np.int64)


def _describe(size: int):
    """Per document its set's size and fingerprint; at the end of a task its share of the sketch."""
    def run(batches):
        counts, waiting, held = np.zeros(SLOTS, np.int64), [], 0
        for batch in batches:
            n, keys = [], []
            for raw in as_bytes(batch.column("text")):
                s = shingle_set(raw, size)
                n.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                waiting.append(_slots(s))
                held += len(s)
                if held > 1_000_000:
                    counts += np.bincount(np.concatenate(waiting), minlength=SLOTS)
                    waiting, held = [], 0
            rows = len(n)
            yield pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                                   pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())],
                                  ["doc_id", "n", "set_key", "block", "counts"])
        if waiting:
            counts += np.bincount(np.concatenate(waiting), minlength=SLOTS)
        if counts.any():
            parts = np.minimum(counts, np.iinfo(np.int32).max).astype("<i4").reshape(_BLOCKS, -1)
            yield pa.record_batch([pa.nulls(_BLOCKS, pa.int64()), pa.nulls(_BLOCKS, pa.int64()),
                                   pa.nulls(_BLOCKS, pa.binary()), pa.array(range(_BLOCKS), pa.int32()),
                                   pa.array([p.tobytes() for p in parts], pa.binary())],
                                  ["doc_id", "n", "set_key", "block", "counts"])
    return run


def _summed(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up one block of counters batch by batch."""
    total = np.zeros(SLOTS // _BLOCKS, np.int64)
    for batch in batches:
        for part in batch.column("counts").to_pylist():
            total += np.frombuffer(part, "<i4")
    yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                          ["block", "counts"])


def _levels(sketch: DataFrame) -> np.ndarray:
    """Rough frequency of each slot as a power of two: SLOTS bytes, whatever the input."""
    levels = np.zeros(SLOTS, np.uint8)
    width = SLOTS // _BLOCKS
    for block, counts in sketch.groupBy("block").applyInArrow(_summed, "block int, counts binary").collect():
        levels[block * width:(block + 1) * width] = np.log2(np.frombuffer(counts, np.int64) + 1).astype(np.uint8)
    return levels


#: Sets over this size also have the wider parity bits.
_LARGE, _NARROW, _WIDE = 1000, 512, 8192


def parities(tokens: np.ndarray, width: int) -> np.ndarray:
    """Bits, each the parity of the tokens that fall on it: two sets differ in at least as many tokens as bits."""
    counts = np.bincount((tokens & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _apart(a: str, b: str):
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _narrow_apart(a: str, b: str):
    """``_apart`` of the narrow bits, written out word by word so that a join's condition compiles it."""
    return reduce(Column.__add__, [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(_NARROW // 64)])


def _prefixes(size: int, percent: int, levels):
    """Each set's rarest tokens, as many as any partner must share one of."""
    def run(batches):
        frequency = levels.value
        for batch in batches:
            n, tokens, keys, bits, wide = [], [], [], [], []
            for raw in as_bytes(batch.column("text")):
                s = shingle_set(raw, size)
                take = len(s) - -(-percent * len(s) // 100) + 1 if len(s) else 0
                first = s[np.lexsort((s, frequency[_slots(s)]))[:take]]
                n.append(len(s))
                tokens.append(first.view(np.int64))
                keys.append(xxhash.xxh3_128_digest(first.tobytes()))
                bits.append(parities(s, _NARROW))
                wide.append(parities(s, _WIDE) if len(s) > _LARGE else None)
            yield pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(tokens, pa.list_(pa.int64())),
                                   pa.array(keys, pa.binary()), pa.array(bits, pa.list_(pa.int64())), pa.array(wide, pa.list_(pa.int64()))],
                                  ["doc_id", "n", "prefix", "prefix_key", "bits", "wide"])
    return run


def _sets(size: int):
    def run(batches):
        for batch in batches:
            sets = [shingle_set(raw, size).view(np.int64) for raw in as_bytes(batch.column("text"))]
            yield pa.record_batch([batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "tokens"])
    return run


def ngram_join(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """Link documents whose sets of ``size``-word shingles have a Jaccard similarity of ``percent`` or more.

    Returns ``(doc_id, n_shingles, component_id)``, a row per row of ``docs``;
    ``component_id`` is the smallest doc_id that links reach.

    Documents with equal sets count once.  A set's tokens are ordered by rough
    corpus frequency (a sketch of fixed size, summed over all documents), then
    by hash; only its first ``n - ceil(t n) + 1`` tokens are joined, as alike
    sets must share one of them.  Sets of one size and one prefix form a group
    that is joined once; group pairs pass a length and a positional bound, are
    expanded to members, pass a bound from parity bits (in the second round
    within the join, so that no pair beyond it is written), and are verified
    on their whole sets.

    Nulls and texts without words have an empty set, which links with nothing:
    their component is their own doc_id.  Texts shorter than a shingle have one
    token, the whole sequence.  A row without doc_id takes the component of the
    others with its set, or null.  Documents are known by doc_id: rows that give
    one doc_id several texts share the links of all.  Other columns are not read; an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    seen = materialize(docs.mapInArrow(
        _describe(size), "doc_id long, n long, set_key binary, block int, counts binary"))
    described = seen.where("block is null").select("doc_id", "n", "set_key")
    levels = spark.sparkContext.broadcast(_levels(seen.where("block is not null").select("block", "counts")))

    first = described.where("n > 0").groupBy("n", "set_key").agg(F.min("doc_id").alias("doc_id"))
    first = materialize(first.where("doc_id is not null"))
    prefixes = docs.where("doc_id is not null and text is not null").mapInArrow(
        _prefixes(size, percent, levels), "doc_id long, n long, prefix array<bigint>, prefix_key binary, bits array<bigint>, wide array<bigint>")
    # a doc_id may come twice with different sets: the set's size tells most apart, verification the rest
    prefixes = materialize(prefixes.join(first.select("doc_id", "n"), ["doc_id", "n"], "left_semi"))
    groups = prefixes.groupBy("n", "prefix_key").agg(F.min("doc_id").alias("id"))
    members = materialize(prefixes.select("doc_id", "n", "prefix_key").join(groups, ["n", "prefix_key"])
                          .select("id", F.col("doc_id").alias("member")).distinct())
    heads = prefixes.join(groups, ["n", "prefix_key"], "left_semi").join(
        groups.select("n", "prefix_key", F.col("id").alias("doc_id")), ["n", "prefix_key", "doc_id"], "left_semi")
    keys = heads.dropDuplicates(["n", "prefix_key"]).select(
        F.col("doc_id").alias("id"), "n", F.posexplode("prefix").alias("pos", "key"))

    def admit(left: str, right: str):
        least, most = F.least(f"{left}.n", f"{right}.n"), F.greatest(f"{left}.n", f"{right}.n")
        reach = F.least(F.col(f"{left}.n") - F.col(f"{left}.pos"), F.col(f"{right}.n") - F.col(f"{right}.pos"))
        reach = reach + F.least(f"{left}.pos", f"{right}.pos")
        return (least * 100 >= most * percent) & (reach * (100 + percent) >= (least + most) * percent)

    bits, wide = prefixes.select("doc_id", "n", "bits").distinct(), prefixes.where("wide is not null").select("doc_id", "wide")

    def near(apart: Column, na: str = "na", nb: str = "nb"):
        return apart * (100 + percent) <= (F.col(na) + F.col(nb)) * (100 - percent)

    def alike(left: str, right: str):
        return near(_narrow_apart(f"{left}.bits", f"{right}.bits"), f"{left}.size", f"{right}.size")

    def prune(pairs: DataFrame) -> DataFrame:
        both = pairs.join(bits.toDF("a", "na", "ba"), "a").join(bits.toDF("b", "nb", "bb"), "b")
        both = materialize(both.where(near(_narrow_apart("ba", "bb"))).select("a", "b", "na", "nb"))
        both = both.join(wide.toDF("a", "wa"), "a", "left").join(wide.toDF("b", "wb"), "b", "left")
        return both.where(F.col("wa").isNull() | F.col("wb").isNull() | near(_apart("wa", "wb"))).select("a", "b").distinct()

    def verify(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        sets = materialize(docs.join(ids, "doc_id", "left_semi").mapInArrow(_sets(size), "doc_id long, tokens array<bigint>"))
        both = pairs.join(sets.toDF("a", "ta"), "a").join(sets.toDF("b", "tb"), "b")
        both = both.withColumn("common", F.size(F.array_intersect("ta", "tb")))
        links = materialize(both.where(F.col("common") * 100 >= (F.size("ta") + F.size("tb") - F.col("common")) * percent)
                            .select("a", "b").distinct())
        discard(sets)
        return links

    found = linked(keys, verify, members=members, admit=admit, prune=prune, marks=bits.toDF("member", "size", "bits"), alike=alike)
    classes = first.join(found.toDF("doc_id", "component"), "doc_id", "left").select(
        "n", "set_key", F.coalesce("component", "doc_id").alias("component_id"))
    return described.join(classes, ["n", "set_key"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
