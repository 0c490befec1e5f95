"""Chat formatting: link tool calls and results, order them, check arguments, write canonical JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.session import discard, materialize

#: Tools, their arguments' types, and which must be given.
SCHEMAS = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "lookup": {"key": ("string", True), "exact": ("boolean", True)},
    "compute": {"expression": ("string", True), "digits": ("integer", True)},
}
_TYPES = {"string": r'^".*"$', "integer": r"^-?[0-9]+$", "boolean": r"^(?:true|false)$"}


_SHORT = {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r"}


def quoted(text: Column) -> Column:
    """Inside of a JSON string: quote, backslash and control characters escaped, all else as it is."""
    out = F.regexp_replace(text, r'(["\\])', r"\\$1")
    for code, mark in _SHORT.items():
        out = F.replace(out, F.lit(chr(code)), F.lit(mark))
    rare = out
    for code in set(range(32)) - set(_SHORT):
        rare = F.replace(rare, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
    return F.when(out.rlike(r"[\x00-\x1F]"), rare).otherwise(out)


def string(text: Column) -> Column:
    return F.concat(F.lit('"'), quoted(text), F.lit('"'))


def canonical(value: Column) -> Column:
    """The one JSON text of a JSON value: keys sorted, no spaces, least escapes, numbers in one form; NULL if it is not JSON.

    An object that names a key twice is not JSON here.  The parser stops after
    one value, so the text is read as an array's first element before a mark
    of its own: that mark comes second only if the text is one value and no more.
    """
    mark = F.hex(F.xxhash64(value))

    def written(parsed: Column) -> Column:
        whole = F.try_variant_get(parsed, "$[1]", "string") == mark
        first = F.try_variant_get(parsed, "$[0]", "variant")
        text = F.when(F.schema_of_variant(first) == "STRING", string(F.try_variant_get(parsed, "$[0]", "string"))).otherwise(F.to_json(first))
        return F.when(whole, text)
    wrapped = F.concat(F.lit("["), value, F.lit(',"'), mark, F.lit('"]'))
    return F.transform(F.array(F.try_parse_json(wrapped)), written)[0]


def problems(name: Column, arguments: Column, schemas: dict = SCHEMAS) -> Column:
    """What is wrong with a call's ``arguments``, a map of name to canonical JSON value (NULL: not JSON); sorted texts."""
    known = F.lit(None).cast("array<string>")
    given = F.map_keys(arguments)
    for tool, fields in schemas.items():
        found = [F.when(~F.array_contains(given, f), F.lit(f"missing {f}")) for f, (_, needed) in fields.items() if needed]
        found += [F.when(F.array_contains(given, f) & ~F.coalesce(F.element_at(arguments, f).rlike("(?s)" + _TYPES[kind]), F.lit(False)),
                         F.lit(f"not {kind}: {f}")) for f, (kind, _) in fields.items()]
        extra = F.transform(F.array_except(given, F.array(*map(F.lit, fields))), lambda x: F.concat(F.lit("unknown "), x))
        all_found = F.concat(F.filter(F.array(*found), lambda x: x.isNotNull()), extra)
        known = F.when(name == tool, all_found).otherwise(known)
    bad_name = F.array(F.lit("unknown tool"))
    return F.when(arguments.isNull(), F.array(F.lit("no arguments"))).otherwise(F.sort_array(F.coalesce(known, bad_name)))


def direct_needs(needs: DataFrame) -> DataFrame:
    """``needs (conv_id, call_id, turn, needed)`` without those that lead round another one: never part of a longest chain.

    A need goes if a later need of the same call has it too.  Of needs that
    name each other in a circle the latest stays, so a cycle is never undone.
    """
    own = needs.groupBy("conv_id", "call_id").agg(F.sort_array(F.collect_set(F.struct("turn", "needed"))).alias("own"))
    own = materialize(own)
    theirs = own.select("conv_id", F.col("call_id").alias("needed"), F.col("own").alias("theirs"))
    each = own.select("conv_id", "call_id", "own", F.explode("own").alias("via")).withColumn("needed", F.col("via.needed"))
    round_about = F.filter(F.array_intersect("own", "theirs"), lambda x: x < F.col("via"))
    gone = each.join(theirs, ["conv_id", "needed"]).select("conv_id", "call_id", F.explode(round_about).alias("gone")) \
        .select("conv_id", "call_id", F.col("gone.needed").alias("needed"))
    return own.select("conv_id", "call_id", F.explode("own.needed").alias("needed")).join(gone, ["conv_id", "call_id", "needed"], "left_anti")


def depths(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """Longest chain of ``needs (conv_id, call_id, needed)`` below each call: ``(conv_id, call_id, depth)``.

    ``calls``: ``conv_id``, ``call_id`` and ``turn``, which only ranks needs.
    A call holds the longest way down known so far and, for each need that is
    still open, the farthest call it leads to and the steps to there.  In a
    round a need that ends at a finished call is closed, and one that ends at
    a call with a single open need is led on to that one's end.  Single needs
    in a row so halve each round, all conversations at once, and a need never
    becomes two: rows stay as many as calls and needs.  Rounds grow with the
    logarithm of a chain, but with its length where every call of it keeps
    several needs that do not lead round one another.  A way longer than the
    number of calls, or needs that only lead to one another, lie on or lead to
    a cycle: null depth.
    """
    key = ["conv_id", "call_id"]
    nodes = materialize(calls.groupBy(*key).agg(F.min("turn").alias("turn")))
    total = nodes.count()
    ends = nodes.select("conv_id", F.col("call_id").alias("needed"), "turn")
    open_needs = direct_needs(needs.select(*key, "needed").distinct().join(ends, ["conv_id", "needed"]))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    # a row without `top` holds a call's longest way down so far
    ways = nodes.select(*key, F.lit(None).cast("string").alias("top"), none.alias("steps"), F.lit(False).alias("moved"))
    ways = materialize(ways.unionByName(open_needs.select(*key, F.col("needed").alias("top"), one.alias("steps"), F.lit(True).alias("moved"))))
    while not ways.where("moved").isEmpty():
        going = F.col("top").isNotNull()
        ahead = ways.groupBy(*key).agg(F.count("top").alias("n"), F.max(F.when(~going, F.col("steps"))).alias("down"),
                                       F.max(F.when(going, F.struct("top", "steps"))).alias("next")).where("n <= 1")
        ahead = ahead.select("conv_id", F.col("call_id").alias("top"), "down", "next")
        way = lambda top, steps, moved: F.struct(top.alias("top"), steps.alias("steps"), F.lit(moved).alias("moved"))
        closed = way(F.lit(None).cast("string"), F.col("steps") + F.col("down"), True)
        led_on = way(F.col("next.top"), F.col("steps") + F.col("next.steps"), True)
        led = F.when(F.col("down").isNull(), F.array(way(F.col("top"), F.col("steps"), False))) \
            .when(F.col("next").isNull(), F.array(closed)).otherwise(F.array(closed, led_on))
        finite = F.col("steps") <= total
        led = ways.where(going & finite).join(ahead, ["conv_id", "top"], "left").select(*key, F.explode(led).alias("w")).select(*key, "w.*")
        still = ways.where(~going | ~finite).select(*key, "top", "steps", F.lit(False).alias("moved"))
        rows = still.unionByName(led).groupBy(*key, "top").agg(F.max("steps").alias("steps"), F.max("moved").alias("moved"))
        old, ways = ways, materialize(rows.withColumn("moved", F.col("moved") & (F.col("steps") <= total)))
        discard(old)
    return ways.groupBy(*key).agg(F.when(F.count("top") == 0, F.max("steps")).alias("depth"))


def link_tool_calls(messages: DataFrame, *, schemas: dict = SCHEMAS) -> DataFrame:
    """Calls with their results, in an order that respects their needs, as canonical JSON.

    ``messages``: ``conv_id``, ``turn``, ``kind`` (call or result), ``call_id``,
    ``name``, ``arguments`` (map of name to JSON value), ``needs`` (array of
    call_ids) and ``content``.  Returns a row per call: ``conv_id``,
    ``call_id``, ``depth``, ``status`` (linked, unanswered or cyclic),
    ``errors`` (comma-joined), ``valid`` and ``json``; and a row per result
    without a call: status orphan.  Sorting a conversation's rows by
    ``(depth, call_id)`` is the topological order; cyclic calls have none.

    Calls and results meet by ``(conv_id, call_id)`` in a hash join.  Of
    messages that repeat one kind and identifier the earliest turn counts, then
    the smallest content.  Needs that name no call of the conversation are
    ignored.  Arguments are parsed: types are checked on the value, and JSON has
    sorted keys at every level, no spaces, one form of a number, and escapes
    only what it must.  A value that is not JSON is an error and is written as
    a string of its text.
    A message without conversation or identifier is left out; null arguments
    are an error, null content becomes JSON null.  Other columns are not read.
    Nothing is gathered per conversation.
    """
    key = ["conv_id", "call_id"]
    known = messages.where("conv_id is not null and call_id is not null")
    entries = lambda m: F.array_sort(F.map_entries(m))  # noqa: E731  maps have no order
    first = lambda kind, *cols: known.where(F.col("kind") == kind).groupBy(*key).agg(
        F.min(F.struct(F.col("turn"), *cols)).alias("m"))
    calls = first("call", F.col("name"), entries(F.col("arguments")).alias("arguments"), F.array_sort("needs").alias("needs"))
    calls = materialize(calls.select(*key, "m.turn", "m.name", F.map_from_entries("m.arguments").alias("arguments"), "m.needs"))
    results = first("result", F.col("content")).select(*key, "m.content", F.lit(True).alias("answered"))
    needs = calls.select(*key, F.explode("needs").alias("needed")).where("needed is not null")
    both = calls.withColumn("called", F.lit(True)).join(results, key, "full").join(depths(calls, needs), key, "left")
    parsed = F.transform_values("arguments", lambda _, v: canonical(F.coalesce(v, F.lit("null"))))
    both = both.withColumn("parsed", parsed)
    args = F.transform(entries(F.col("arguments")), lambda e: F.concat(
        string(e["key"]), F.lit(":"), F.coalesce(F.element_at("parsed", e["key"]), string(e["value"]))))
    body = F.concat(F.lit('{"arguments":'), F.when(F.col("arguments").isNull(), F.lit("null")).otherwise(F.concat(F.lit("{"), F.array_join(args, ","), F.lit("}"))),
                    F.lit(',"id":'), string(F.col("call_id")), F.lit(',"name":'), F.coalesce(string(F.col("name")), F.lit("null")),
                    F.lit(',"result":'), F.coalesce(string(F.col("content")), F.lit("null")), F.lit("}"))
    status = F.when(F.col("called").isNull(), "orphan").when(F.col("depth").isNull(), "cyclic") \
        .when(F.col("answered").isNull(), "unanswered").otherwise("linked")
    errors = F.when(F.col("called").isNull(), F.array(F.lit("no call"))).otherwise(problems(F.col("name"), F.col("parsed"), schemas))
    return both.select(*key, "depth", status.alias("status"), F.array_join(errors, ",").alias("errors"),
                       ((F.size(errors) == 0) & (status == "linked")).alias("valid"), body.alias("json"))
