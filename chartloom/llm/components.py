"""Connected groups of candidates, without listing the pairs of a group.

``link_buckets`` takes buckets of nodes that may be linked.  It first compares
every node with the leader of one of its buckets only; if asked for, leaders are
the nodes that share most buckets with others, such as the text that the others
of a group were made from.  Nodes that are connected by then need no further
comparison, which settles large groups of near copies.  As long as much is open,
it goes on with other leaders; at last it compares every pair of a bucket that
is still in different groups.  So no link that joins two groups is missed,
however large a bucket is.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.llm.common import BROADCAST_ROWS, materialize, small_or_not

# Rounds with single leaders go on while the open pairs outnumber the bucket
# rows by this factor.
OPEN_PER_ROW, MOST_ROUNDS = 0.25, 6
ROWS_PER_TASK, LEAST_TASKS = 250_000, 4
PAIRS_PER_TASK = 5_000


def _marks(edges: DataFrame) -> tuple:
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()


def _written(df: DataFrame, label: str, rows: int, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Write ``df`` with one task for each ``per_task`` of the rows it was made from."""
    return materialize(df.coalesce(max(LEAST_TASKS, -(-rows // per_task))), label)


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes of the written links (u, v); the label is the least node.

    Alternates large-star and small-star steps and writes the edges after each
    pair of them; a number of steps logarithmic in the size suffices.  While the
    edges are few, the least neighbours are broadcast.
    """
    size = links.count()
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    edges = _written(edges, "edges", size)
    before = _marks(edges)
    while before[0]:
        send = F.broadcast if 2 * before[0] <= BROADCAST_ROWS else lambda df: df
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(send(least), "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(send(least), "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        small = small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct()
        edges = _written(small, "stars", before[0])
        after = _marks(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return _written(edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(roots), "labels", before[0])


def _with_keys(rows: DataFrame) -> DataFrame:
    """Rows (key, node) with keys, all keys of the node."""
    return rows.join(rows.groupBy("node").agg(F.collect_set("key").alias("keys")), "node")


def _first_meeting(one: str, other: str) -> Column:
    """Whether the key is the least that two nodes share, so that a pair comes once and not from each bucket."""
    return F.array_min(F.array_intersect(one + "keys", other + "keys")) == F.col(one + "key")


def link_buckets(
    buckets: DataFrame | list[DataFrame],
    verify: Callable[[DataFrame], DataFrame],
    carried: DataFrame | None = None,
    near: Callable[[str, str], Column] | None = None,
    open_per_row: float = OPEN_PER_ROW,
    central: bool = False,
    sketch: Callable[[DataFrame], DataFrame] | None = None,
    alike: Callable[[str, str], Column] | None = None,
) -> DataFrame:
    """(node, label) of all linked nodes.

    ``buckets``: rows (key, node), each once; a list of such tables without common
    keys is dealt out one by one, which takes less disk.  With a further column ``at``,
    a node's place in a bucket, rows may come once for each place; of several, ``at`` is null.
    ``verify`` takes pairs (u, v) with u < v and returns those that are links.  ``carried`` has further
    columns of each node; ``near``, given the prefixes of both sides, is a
    condition on them that every link meets and that is cheap enough to be
    tested inside the joins.  ``central`` leads with the nodes that share most
    buckets.  ``sketch`` gives further columns of nodes (a column ``node``) for
    the comparison of all open pairs, and ``alike`` is a condition on them.
    """
    # rows are dealt out by key once, and only keys of several nodes are written
    label = "shared-keys" if central else "shared-buckets"
    parts = buckets if isinstance(buckets, list) else [buckets]
    parts = [p.withColumn("n", F.count("*").over(Window.partitionBy("key"))).filter("n > 1") for p in parts]
    if central or carried is not None or len(parts) > 1:
        parts = [materialize(p if central else p.drop("n"), label) for p in parts]
    buckets = reduce(DataFrame.unionAll, parts)
    if central:
        degrees = buckets.groupBy("node").agg((-F.sum("n")).alias("rank"))
        buckets = buckets.drop("n").join(degrees, "node")
    else:
        buckets = buckets.select(*(c for c in buckets.columns if c != "n")).withColumn("rank", F.lit(0).cast("long"))
    extra = [c for c in carried.columns if c != "node"] if carried is not None else []
    if carried is not None:
        buckets = buckets.join(carried, "node")
    if "at" in buckets.columns:
        buckets = buckets.groupBy("key", "node", "rank", *extra).agg(F.when(F.min("at") == F.max("at"), F.min("at")).alias("at"))
        extra = [*extra, "at"]
    buckets = materialize(buckets.select("key", "node", "rank", *extra), "shared-buckets")
    meets = near or (lambda one, other: F.lit(True))
    labels = links = tried = None
    last = False
    for turn in range(MOST_ROUNDS + 1):
        rows = buckets.withColumn("label", F.col("node"))
        if turn:
            named = buckets.join(small_or_not(labels), "node", "left")
            rows = named.withColumn("label", F.coalesce("label", "node"))
            sizes = rows.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key")
            open_pairs = (F.pow(F.sum("n"), F.lit(2)) - F.sum(F.col("n") * F.col("n"))) / 2
            mixed = sizes.agg(open_pairs.alias("p"), F.sum("n").alias("n")).filter("p > 0")
            mixed = _written(mixed, "open-buckets", 1)
            total, n = mixed.agg(F.sum("p"), F.sum("n")).first()
            if not total:
                break
            last = turn == MOST_ROUNDS or total <= open_per_row * n
            rows = rows.join(small_or_not(mixed.select("key")), "key", "left_semi")
        order = F.struct("rank", "node") if not turn else F.struct(F.lit(0).cast("long"), F.xxhash64("node", F.lit(turn)))
        if last:
            if sketch is not None:
                rows = rows.join(materialize(sketch(rows.select("node").distinct()), "sketches"), "node")
                rows = _with_keys(rows)
            others = rows.alias("m")
            apart = (F.col("l.key") == F.col("m.key")) & (F.col("l.node") < F.col("m.node"))
            if alike is not None:
                apart = apart & alike("l.", "m.")
        else:
            leader = F.min(F.struct(order.alias("order"), "node", "label", *extra))
            others = rows.groupBy("key").agg(leader.alias("m")).select("key", "m.*").alias("m")
            apart = F.col("l.key") == F.col("m.key")
        apart = apart & (F.col("l.label") != F.col("m.label")) & meets("l.", "m.")
        if last and sketch is not None:
            apart = apart & _first_meeting("l.", "m.")
        met = rows.alias("l").join(others, apart)
        if last:
            met = met.select(F.col("l.node").alias("node"), F.col("m.node").alias("other")).distinct()
        else:
            # a node meets one leader a turn, however many buckets it is in
            met = met.groupBy(F.col("l.node").alias("node")).agg(F.min(F.struct("m.order", "m.node")).alias("first"))
            met = met.select("node", F.col("first.node").alias("other"))
        pairs = met.select(F.least("node", "other").alias("u"), F.greatest("node", "other").alias("v")).distinct()
        if tried is not None:
            pairs = pairs.join(small_or_not(tried), ["u", "v"], "left_anti")
        pairs = materialize(pairs, "pairs")
        found = _written(verify(pairs).select("u", "v"), "links", pairs.count(), PAIRS_PER_TASK)
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        labels = components(links)
        if last:
            break
    return labels
