"""Quality rules: document statistics, fixed limits, and boosted trees with monotonic constraints."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm import boosting

_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Features of the trees, and which way the score may move with them.
FEATURES = ["log_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share",
            "mark_share", "distinct_share", "top_word_share", "line_words", "odd_share"]
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1}


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The five counts and the features of one whole text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # on exactly space and \t-\r, as bytes
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in _SPACES)
    symbols = sum(text.count(c) for c in _SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    dups = len(lines) - len(set(lines))
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    repeat = 0
    if n >= 3:
        pairs = np.unique(w[:-1] * len(ids) + w[1:], return_inverse=True)[1]
        found, inverse, count = np.unique(pairs[:-1] * len(ids) + w[2:], return_inverse=True, return_counts=True)
        twice = count[inverse] > 1
        hit = np.zeros(n, bool)
        for j in range(3):
            hit[j:n - 2 + j] |= twice
        repeat = int(hit.sum())
    some = max(n, 1)
    b = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, digit = b[65:91].sum(), b[48:58].sum()
    marks = b[33:48].sum() + b[58:65].sum() + b[91:97].sum() + b[123:127].sum()
    known = b[97:123].sum() + upper + digit + marks + b[128:].sum() / 2
    top = np.bincount(w).max() if n else 0
    return [n, chars, symbols, dups, repeat], [
        np.log1p(n), chars / some, symbols / max(chars, 1), dups / max(len(lines), 1), repeat / some,
        upper / max(chars, 1), digit / max(chars, 1), marks / max(chars, 1), len(ids) / some, top / some,
        n / max(len(lines), 1), 1 - min(1.0, known / max(len(raw), 1))]


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])


def _features():
    def run(batches):
        for batch in batches:
            rows = [statistics(t)[1] for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("quality"), pa.array(rows, pa.list_(pa.float64()))], ["quality", "x"])
    return run


def train(docs: DataFrame, labels: DataFrame, *, rows: int = 4000, lost: float = 0.005):
    """Fit the trees on at most ``rows`` labelled documents, those with the smallest hash of doc_id.

    Returns ``(forest, threshold)``.  A fifth of the sample is held out; the
    threshold lets at most the share ``lost`` of its good documents score
    lower.  None if the sample lacks one of the classes or has under 40 rows.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).where("doc_id is not null and quality is not null")
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    got = docs.join(F.broadcast(sample), "doc_id").select("quality", "text") \
        .mapInArrow(_features(), "quality int, x array<double>").limit(2 * rows).collect()  # a doc_id may repeat
    x, y = np.array([r.x for r in got], float).reshape(-1, len(FEATURES)), np.array([r.quality for r in got])
    order = np.lexsort((*x.T, y))  # whatever order the rows came in
    x, y = x[order], y[order]
    held = np.arange(len(y)) % 5 == 4
    if len(y) < 40 or not 0 < y[~held].sum() < (~held).sum():
        return None
    forest = boosting.fit(x[~held], y[~held], monotone={FEATURES.index(k): v for k, v in MONOTONE.items()})
    good = np.sort(forest.raw(x)[(y == 1)])
    held_good = np.sort(forest.raw(x[held])[y[held] == 1])
    at = min(np.quantile(held_good, lost) if len(held_good) else 0.0, np.quantile(good, lost))
    return forest, min(float(at), 0.0) - 1e-9


def _scored(model):
    forest, threshold = model.value or (None, 0.0)

    def run(batches):
        for batch in batches:
            both = [statistics(t) for t in batch.column("text").to_pylist()]
            counts = np.array([a for a, _ in both], np.int64).reshape(-1, len(COUNTS))
            x = np.array([b for _, b in both], float).reshape(-1, len(FEATURES))
            failed = base_failed(counts)
            score = forest.raw(x) if forest and len(x) else np.zeros(len(x))
            kept = ~failed & (score >= threshold)
            rest = [c for i, c in enumerate(batch.columns) if batch.schema.names[i] != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.record_batch([*rest, *counts.T.copy(), pa.array(failed), pa.array(score), pa.array(kept)],
                                  [*names, *COUNTS, "base_failed", "score", "kept"])
    return run


def quality_rules(docs: DataFrame, labels: DataFrame, *, rows: int = 4000, lost: float = 0.005) -> DataFrame:
    """Counts and verdict of every document: ``doc_id``, five counts, ``base_failed``, ``score``, ``kept``.

    ``base_failed``: under 50 words, or over half of the words in three-word
    windows that come twice.  ``kept``: not ``base_failed``, and the trees
    (see ``train``) score it at or above their threshold.  The score can only
    fall with the shares of symbols, repeated lines and repeated words.

    A null text counts as empty and fails.  Where labels are too few for
    training, the fixed limits alone decide.  Repeated rows are judged alike,
    null ids too; other columns are not read; an empty table gives none.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, rows=rows, lost=lost))
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, score double, kept boolean"
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(_with(model), schema)


def _with(model):
    return lambda batches: _scored(model)(batches)


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` that ``quality_rules`` keeps, with their columns as they were."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, **options))
    columns, schema = docs.columns, docs.schema

    def run(batches):
        for batch in batches:
            judged = next(_scored(model)(iter([batch.select(["text"])])))
            yield batch.filter(judged.column("kept"))
    return docs.mapInArrow(run, schema) if "text" in columns else docs
