"""Connected components, and component search over shared keys without forming all pairs of a group."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.session import broadcast_if_small, discard, materialize


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id of every node of the undirected ``edges (a, b)``, as ``(id, component)``.

    Rounds of contraction: every node points to its smallest neighbour (or
    itself), chains of pointers are halved until all point to a root, and the
    edges are rewritten between roots.  Nothing is gathered per component, and
    each round's tables are written to the shared folder.  Loops and repeated
    edges do no harm; an end that is null is ignored.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    edges = materialize(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    while not edges.isEmpty():
        parent = materialize(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                             .select("node", F.least("node", "low").alias("parent")))
        while True:
            up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            chained = parent.join(up, "parent")
            if chained.where("above <> parent").isEmpty():
                break
            parent, old = materialize(chained.select("node", F.col("above").alias("parent"))), parent
            discard(old)
        labels = materialize(labels.join(parent, labels.component == parent.node, "left")
                             .select("id", F.coalesce("parent", "component").alias("component")))
        a, b = parent.toDF("a", "pa"), parent.toDF("b", "pb")
        edges = materialize(edges.join(a, "a").join(b, "b").where("pa <> pb")
                            .select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct())
    return labels


def linked(keys: DataFrame | list[DataFrame], verify: Callable[[DataFrame], DataFrame], *, members: DataFrame | None = None,
           admit: Callable[[str, str], Column] | None = None, prune: Callable[[DataFrame], DataFrame] | None = None,
           marks: DataFrame | None = None, alike: Callable[[str, str], Column] | None = None,
           narrow: Callable[[DataFrame], DataFrame] | None = None,
           search: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Components of the graph that links two ids sharing a key if ``verify`` accepts them.

    ``keys``: ``(key, id)``, each once, and any attributes that ``admit(left, right)``
    compares to rule a pair out cheaply.  ``members (id, member)``: what an id
    stands for, if ids are groups; pairs are then formed between members, and
    members of one id count as sharing a key.
    ``verify`` takes distinct pairs ``(a, b)``, ``a < b``, and returns those that
    are links, as a written table.  ``prune`` takes such pairs too and drops
    those that a cheap bound on the ids alone rules out.  ``marks (member, ...)``:
    columns by which ``alike(left, right)`` rules members out inside the join
    of the second round; a member with several rows is compared by each.
    ``search``: finds the second round's links itself, so that pairs need not be
    rows.  ``narrow`` takes rows of a key, ``id``, its attributes and ``component``,
    and the key's number of rows ``n``, and returns those that can be in a link.
    ``search`` takes them as written tables without a common key, which it
    discards, and returns links ``(a, b)`` of ids of one
    key and different components as a written table.  Both need ``admit``, and
    ``members`` to be None.  ``keys`` may then be several frames without a common
    key: they are shuffled one after the other as they are made and never
    written whole, for keys much larger than the input.

    Every link is found or lies inside a component that other links hold
    together: first each key's ids are paired with the smallest of them, and
    an id is compared with the partner that it gets so most often; then, within keys whose members are not yet in one component, every
    member outside the most common component is compared with all members of
    other components.  A group of copies thus costs a comparison each.
    Returns ``(id, component)`` for members that have a link.
    """
    parts = keys if isinstance(keys, list) else [keys]
    own = F.struct("id", *[c for c in parts[0].columns if c not in ("key", "id")])
    if search is not None:
        same_key = Window.partitionBy("key")
        center = F.when((F.col("id") != F.col("least.id")) & admit("least", "own"), F.col("least.id"))
        columns = ["key", *[c for c in parts[0].columns if c != "key"], "n", center.alias("center")]
        written = []
        for part in parts:
            part = part.withColumn("own", own).withColumn("n", F.count(F.lit(1)).over(same_key)).withColumn("least", F.min("own").over(same_key))
            written.append(materialize(part.where("n > 1").select(columns)))
        shared = reduce(DataFrame.union, written)
    else:
        keys = materialize(keys)
        several = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
        shared = materialize(keys.join(several, "key", "left_semi"))
    alone = None
    if members is not None:
        # a group that shares no key with another still has its members to compare: any one of its keys will do
        crowded = members.where("id <> member").select("id").distinct()
        alone = keys.join(crowded, "id", "left_semi").join(shared.select("id").distinct(), "id", "left_anti")
        alone = materialize(alone.groupBy("id").agg(F.min(F.struct("key", own.alias("own"))).alias("k"))
                            .select("k.key", "k.own.*").select(*keys.columns))
    if search is not None:
        pairs = shared.where("center is not null").select(F.col("center").alias("a"), F.col("id").alias("b"))
    else:
        discard(keys)
        centers = shared.groupBy("key").agg(F.min(own).alias("center"))
        pairs = shared.join(centers, "key").withColumn("own", own).where("id <> center.id")
        if admit is not None:
            pairs = pairs.where(admit("center", "own"))
        pairs = pairs.select(F.col("center.id").alias("a"), F.col("id").alias("b"))
    if members is not None:
        pairs = pairs.union(members.where("id <> member").select(F.col("id").alias("a"), F.col("member").alias("b")))
    prune = prune or (lambda found: found)
    often = pairs.groupBy("a", "b").agg((-F.count(F.lit(1))).alias("n"))
    often = often.groupBy("b").agg(F.min(F.struct("n", "a")).alias("best")).select("best.a", "b")
    pairs = materialize(prune(_ordered(often)))
    first = verify(pairs)
    discard(pairs)
    labels = components(first)

    if search is not None:
        component = broadcast_if_small(labels.toDF("id", "component"))
        found = []
        for part in written:
            rows = part.drop("center").join(component, "id", "left").withColumn("component", F.coalesce("component", "id"))
            found.append(materialize(narrow(rows)))
            discard(part)
        return components(first.union(search(found)))
    rows = shared if alone is None else shared.union(alone.select(*shared.columns))
    if members is None:
        rows = rows.withColumn("member", F.col("id"))
    else:
        within = members.join(labels.toDF("member", "component"), "member", "left") \
            .withColumn("component", F.coalesce("component", "member"))
        several = within.groupBy("id").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        mixed = rows.join(several, "id").groupBy("key").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        rows = rows.join(mixed.where("low <> high").select("key"), "key").join(members, "id")
    rows = rows.join(labels.toDF("member", "component"), "member", "left") \
        .withColumn("component", F.coalesce("component", "member"))
    sizes = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"),
                                    F.count(F.lit(1)).alias("parts")).where("parts > 1").select("key", "main")
    rows = rows.join(main, "key")
    rows = materialize(rows if marks is None else rows.join(marks, "member"))
    discard(*[x for x in (shared, alone) if x is not None])
    rest = rows.where("component <> main").alias("l").join(rows.alias("r"), F.expr(
        "l.key = r.key and l.component <> r.component and (r.component = r.main or l.member < r.member)"))
    if admit is not None:
        rest = rest.where(admit("l", "r"))
    if alike is not None:
        rest = rest.where(alike("l", "r"))
    rest = _ordered(rest.select(F.col("l.member").alias("a"), F.col("r.member").alias("b")))
    rest = materialize(prune(rest))
    discard(rows)
    second = verify(rest)
    discard(rest)
    return components(first.union(second))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
