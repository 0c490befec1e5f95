"""Personal data: high-recall candidate spans, boosted trees over format and context, calibrated thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm import boosting
from wattloom.session import discard, materialize

KINDS = ("email", "ip", "card", "phone")
#: Base patterns.  Possessive repeats and the look-behind only save time: a match never gives back what they take, and
#: inside a run of its own characters a match can start only where the previous one ended.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators of candidates; they overlap one another and the base patterns.
CANDIDATES = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9A-Fa-f:.])|\G)(?:[0-9A-Fa-f]{1,4}+:){3,7}[0-9A-Fa-f]{1,4}|(?<![0-9.])[0-9]{1,4}(?:[.,][0-9]{1,4}){3,5}",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]{0,2}[0-9]){11,24}",
    "phone": r"(?<![0-9])(?:\+|00)?[(]?[0-9](?:[\x20()./-]{0,3}[0-9]){6,15}",
}
_CONTEXT = 24
_CUES = {"email": r"(?i)(?:mail|contact|write|@)", "ip": r"(?i)(?:\bip\b|address|host|server)",
         "card": r"(?i)(?:card|visa|credit|pay)", "phone": r"(?i)(?:tel|phone|call|fax|mobil)"}
_OTHER_CUES = r"(?i)(?:order|invoice|number|isbn|serial|version|item|part|\bno|\bid|\bref|#)[\x20.:#]*$"
FEATURES = ["n_chars", "n_digits", "n_letters", "n_groups", "longest_group", "n_spaces", "n_dots", "n_dashes", "n_brackets",
            "lead", "luhn", "top_part", "before_space", "after_space", "cue", "doc_digits"]


def _found(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as an array of ``(start, stop, span)``, in code points."""
    spans, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<start:int,stop:int,span:string>>")
    begin = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc, pair):
        start = acc["at"] + F.char_length(pair["gap"])
        stop = start + F.char_length(pair["span"])
        return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(F.struct(
            start.cast("int").alias("start"), stop.cast("int").alias("stop"), pair["span"].alias("span")))).alias("out"))
    pairs = F.zip_with(gaps, spans, lambda g, s: F.struct(g.alias("gap"), s.alias("span")))
    matched = F.filter(pairs, lambda p: p["span"].isNotNull())
    return F.when(text.rlike(pattern), F.aggregate(matched, begin, step)["out"]).otherwise(empty)


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit is right; every second digit from the right counts double, less 9 if over 9."""
    cells = F.split(F.reverse(digits), "")
    values = F.transform(cells, lambda c, i: F.when(i % 2 == 0, c.try_cast("int")).otherwise(
        F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.try_cast("int") + 1)))
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0))) % 10 == 0


def _valid(kind: str, span: Column) -> Column:
    n = F.char_length(_digits(span))
    if kind == "ip":  # leading zeros aside, three figures
        return F.forall(F.split(span, r"\."), lambda p: F.ltrim(p, F.lit("0")).rlike(r"^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.when((n >= 16) & (n <= 19), luhn(_digits(span))).otherwise(False)
    if kind == "phone":
        return (n >= 8) & (n <= 15)
    return F.lit(True)


def base_spans(text: Column) -> dict[str, Column]:
    """Valid base matches of each kind."""
    def of(kind: str) -> Column:
        return F.filter(_found(text, BASE[kind]), lambda s: _valid(kind, s["span"]))
    return {k: of(k) for k in KINDS}


def _features(kind: str, text: Column, found: Column, doc_digits: Column) -> Column:
    span, start, stop = found["span"], found["start"], found["stop"]
    count = lambda pattern: F.char_length(F.regexp_replace(span, pattern, "")).cast("double")
    groups = F.regexp_extract_all(span, F.lit("[0-9]+"), F.lit(0))
    longest = F.coalesce(F.array_max(F.transform(groups, F.char_length)), F.lit(0)).cast("double")
    before = F.substring(text, F.greatest(start - _CONTEXT, F.lit(0)) + 1, F.least(start, F.lit(_CONTEXT)))
    after = F.substring(text, stop + 1, F.lit(1))
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    values = [F.char_length(span).cast("double"), count("[^0-9]"), count("[^A-Za-z]"), F.size(groups).cast("double"), longest,
              count("[^ ]"), count(r"[^.]"), count("[^-]"), count("[^()]"),
              flag(F.substring(span, 1, 1).isin("+", "(")), flag(luhn(_digits(span))),
              F.coalesce(F.array_max(F.transform(groups, lambda g: F.substring(g, 1, 6).cast("double"))), F.lit(0.0)),
              flag(before.rlike(r"(?:^|\s)$")), flag(after.rlike(r"^(?:$|[\s.,;:!?])")), flag(before.rlike(_CUES[kind])), doc_digits]
    return F.struct(*[v.alias(n) for v, n in zip(values, FEATURES)])


def label(kind: str, text: Column, found: Column) -> Column:
    """Whether a candidate surely is personal data or surely not, by its format and cue words; null if neither.

    Does not depend on the base patterns.
    """
    span, start = found["span"], found["start"]
    before = F.substring(text, F.greatest(start - _CONTEXT, F.lit(0)) + 1, F.least(start, F.lit(_CONTEXT)))
    digits = _digits(span)
    n, spaced, cue, other = F.char_length(digits), span.rlike(r"[0-9)][\x20()./-]+[0-9(]"), before.rlike(_CUES[kind]), before.rlike(_OTHER_CUES)
    if kind == "email":
        yes = span.rlike(r"(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z]{2,24}$") & span.rlike(r"\(at\)|\[at\]|[A-Za-z0-9]@[A-Za-z0-9]")
        no = span.rlike(r"(?:\.|\(dot\)|\[dot\])\x20?[0-9-]+$")
    elif kind == "ip":
        yes = span.rlike(r"^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$") | (span.rlike(r"^[0-9]+(?:\.[0-9]+){3}$") & _valid("ip", span) & ~other)
        no = span.rlike(",|^[0-9]{1,2}(?::[0-9]{2}){2,3}$") | span.rlike(r"^(?:[0-9A-Fa-f]+:){3,6}[0-9A-Fa-f]+$") \
            | span.rlike(r"^[0-9]+(?:\.[0-9]+){4,}$") | (span.rlike(r"^[0-9]+(?:\.[0-9]+){3}$") & ~_valid("ip", span))
    elif kind == "card":
        yes = luhn(digits) & (n >= 13) & (n <= 19) & ~other & (cue | span.rlike(r"^[0-9]{4}([\x20./-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}$"))
        no = ~luhn(digits) | (n < 13) | (n > 19)
    else:
        day = span.rlike(r"^(?:[0-9]{4}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{4})(?:\x20|$)")
        day = day | span.rlike(r"^[0-9]{1,4}(?:\.[0-9]{1,4}){3,}$")  # figures of an address or a version
        yes = (n >= 8) & (n <= 15) & spaced & ~day & ~other & (cue | span.rlike(r"^(?:\+|00)[1-9]"))
        no = day | other | (n < 7) | (n > 15) | (~spaced & ~cue & ~span.startswith("+"))
    return F.when(yes, True).when(no, False)


def _candidates(text: Column, base: dict[str, Column]) -> Column:
    """All kinds' candidates ``(kind, start, stop, span, known, label, f)``; ``known``: a valid base match lies there."""
    doc_digits = F.least(F.char_length(F.regexp_replace(text, "[^0-9]", "")) * 100.0 / F.greatest(F.char_length(text), F.lit(1)), F.lit(100.0))

    def of(kind: str) -> Column:
        return F.transform(_found(text, CANDIDATES[kind]), lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["span"].alias("span"),
            F.exists(base[kind], lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])).alias("known"),
            label(kind, text, s).alias("label"), _features(kind, text, s, doc_digits).alias("f")))
    return F.concat(*[of(k) for k in KINDS])


def train(docs: DataFrame, *, precision: float = 0.98) -> dict[str, tuple[boosting.Forest, float]]:
    """Fit trees of each kind on all of its labelled candidates.

    ``label`` tells which candidates count; those without a label are left
    out.  A third of them, by a hash of document and place, is held out; a
    kind's threshold is the lowest score from which on held-out candidates
    reach ``precision``.  Kinds without both classes, or with few candidates,
    take trees that are fitted on the candidates of all kinds.  No trees have
    kinds whose trees never reach ``precision``, and all kinds if the
    candidates of all together lack a class.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    some = docs.where(text.rlike("[0-9@]|[(\\[]at[)\\]]")).select("doc_id", text.alias("text"))
    some = some.withColumns({k: c for k, c in base_spans(F.col("text")).items()})
    found = some.select("doc_id", F.explode(_candidates(F.col("text"), {k: F.col(k) for k in KINDS})).alias("c"))
    labelled = materialize(found.where("c.label is not null").select(
        (F.pmod(F.xxhash64("doc_id", "c.kind", "c.start", "c.span"), F.lit(3)) == 2).alias("held"), F.col("c.kind").alias("model"),
        F.col("c.label").alias("y"), F.array(*[f"c.f.{n}" for n in FEATURES]).alias("x")))
    sizes = labelled.where("not held").groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count_if("y").alias("yes")).collect()
    own = {r.model for r in sizes if r.n >= 40 and 0 < r.yes < r.n}
    rows = labelled.where(F.col("model").isin(*own))
    if {r.model for r in sizes} - own:
        rows = rows.union(labelled.withColumn("model", F.lit("all")))
    fitted = boosting.fit_all(rows, len(FEATURES), trees=12, depth=3, rate=0.4, precision=precision)
    discard(labelled)
    models = {k: fitted.get(k if k in own else "all") for k in KINDS}
    return {k: (forest, at - 1e-6) for k, (forest, at) in ((k, m) for k, m in models.items() if m) if at is not None}  # SQL has the leaves rounded


def find_pii(docs: DataFrame, *, precision: float = 0.98) -> DataFrame:
    """Spans of personal data in every text.

    Returns per row of ``docs``: ``doc_id``, ``base`` and ``added``, arrays of
    ``(kind, start, stop)`` by kind (email, ip, card, phone) and start, in code
    points, ``stop`` exclusive.  ``base`` are the patterns' leftmost
    non-overlapping matches that pass their check.  ``added`` are candidates
    of the generators that the kind's trees (see ``train``) score at its
    threshold or above (of a kind without trees, those labelled as personal
    data), that no label calls surely not personal, that overlap no base span, and that no overlapping
    candidate beats by score, then by place.

    A null or empty text has no spans.  Repeated rows get equal spans, null
    ids too; other columns are not read; an empty table gives none.
    Everything is evaluated row by row in the JVM without a shuffle of rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    models = train(docs, precision=precision)
    out = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = out.withColumns({k: c for k, c in base_spans(F.col("text")).items()})
    out = out.withColumn("base", F.concat(*[
        F.expr(f"transform({k}, s -> struct('{k}' as kind, s.start as start, s.stop as stop))") for k in KINDS]))
    none = F.array().cast("array<struct<kind:string,start:int,stop:int,score:double>>")
    out = out.withColumn("open", F.filter(_candidates(F.col("text"), {k: F.col(k) for k in KINDS}),
                                          lambda c: ~c["known"] & F.coalesce(c["label"], F.lit(True))))
    score = "case " + " ".join(f"when c.kind = '{k}' then {m.sql([f'c.f.{n}' for n in FEATURES])} - ({at!r}D)"
                               for k, (m, at) in models.items()) + " when c.label then 0D end"
    out = out.withColumn("scored", F.when(F.size("open") > 0, F.expr(
        f"transform(open, c -> struct(c.kind as kind, c.start as start, c.stop as stop, {score} as score))")).otherwise(none))
    out = out.withColumn("likely", F.expr("filter(scored, c -> c.score >= 0 and not exists(base, b -> b.start < c.stop and c.start < b.stop))"))
    out = out.withColumn("added", F.expr("""filter(likely, c -> not exists(likely, o -> o.start < c.stop and c.start < o.stop
        and (o.score > c.score or (o.score = c.score and (o.start < c.start or (o.start = c.start and (o.stop > c.stop
             or (o.stop = c.stop and o.kind < c.kind))))))))"""))
    return out.select("doc_id", "base", F.expr("transform(added, c -> struct(c.kind as kind, c.start as start, c.stop as stop))").alias("added"))
