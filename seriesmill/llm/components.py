"""Distributed union-find, and the search for links inside lists of candidates.

Nothing here is collected: labels and links are tables in the shared folder, so a lost executor costs
a task, not the run.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.spans import SKETCH_WORDS
from seriesmill.sources.tables import discard, materialise, same_folder


def components(links: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) for every id of the links (a, b).

    The result is a written table (``discard`` it). Every node takes the smallest label around it, then the label of its label, until nothing
    changes: stars take one round, and a chain of n nodes about log n. Ids of one component meet
    only as rows of joins, which adaptive execution splits if one component is very large.
    """
    both = materialise(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a != b").distinct(), "links")
    labels = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("component"))
    while True:
        around = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("around"))
        near = labels.join(around, "id").select("id", F.col("component").alias("before"), F.least("component", "around").alias("near"))
        step = near.join(labels.select(F.col("id").alias("near"), F.col("component").alias("far")), "near", "left")
        written = materialise(step.select("id", "before", F.coalesce("far", "near").alias("component")), "labels")
        discard(labels)
        if written.where("before != component").isEmpty():
            discard(both)
            return same_folder(written.select("id", "component"), written)
        labels = same_folder(written.select("id", "component"), written)


def within_reach(x: Column, y: Column, percent: int) -> Column:
    """False only where ``size`` or ``sketch`` prove that the Jaccard similarity of two sets is below ``percent``.

    At that similarity the sizes are in proportion, and the sets differ in no more than
    (100 - percent) / (100 + percent) of their values together (a bitmap filter, see Sandes et al.,
    Bitmap filter: speeding up exact set similarity joins with bitwise operations, 2020).
    """
    differing = sum((F.bit_count(x["sketch"][k].bitwiseXOR(y["sketch"][k])) for k in range(SKETCH_WORDS)), F.lit(0))
    sizes = 100 * F.least(x["size"], y["size"]) >= percent * F.greatest(x["size"], y["size"])
    return sizes & ((100 + percent) * differing <= (100 - percent) * (x["size"] + y["size"]))


def _heaviest(rows: DataFrame) -> DataFrame:
    """key, left, of: row and component of the greatest weight in each list, the smallest id among equals.

    Fixed-width maxima and minima, so that the aggregates stay hash aggregates.
    """
    best = rows.groupBy("key").agg(F.max("row.weight").alias("best"))
    first = rows.join(best, "key").where(F.col("row.weight") == F.col("best")).groupBy("key").agg(F.min("row.id").alias("pivot"))
    return rows.join(first, "key").where(F.col("row.id") == F.col("pivot")).select("key", F.col("row").alias("left"), F.col("component").alias("of"))


def link_lists(lists: DataFrame, may_link: Callable[[Column, Column], Column], verify: Callable[[DataFrame], DataFrame], pivots: int = 2) -> DataFrame:
    """id, component of ids that links join; every two ids of one list (column key) are candidates.

    ``may_link`` gets two rows of a list as structs and is false only where a link is impossible. If
    there is a column ``keys`` (all lists of the id), a pair that meets in several lists is made in the first only.
    ``verify`` turns pairs (a, b) into those that really link. Inside a list only pairs that lie in
    different components so far are tested: first all ids against one pivot, which settles lists of
    copies in time linear in their length, then those left against another pivot, then all pairs
    still open. No link between components is lost, since in the end every candidate pair was
    tested or lies in one component. Tables on the way are deleted as soon as the next one is written.
    """
    given = lists = materialise(lists, "lists")
    # An id of long lists is close to many others: the original among its copies makes the best pivot.
    lengths = lists.groupBy("key").agg(F.count("*").alias("length"))
    weights = lists.join(lengths, "key").groupBy("id").agg(F.sum("length").alias("weight"))
    lists = materialise(lists.join(weights, "id"), "weighted-lists")
    discard(given)
    row = F.struct(*[c for c in lists.columns if c != "key"])
    founds: list[DataFrame] = []
    known = None
    for turn in range(pivots + 1):
        placed = lists.select("key", row.alias("row"), F.col("id").alias("component"))
        if known is not None:
            placed = materialise(lists.join(known, "id", "left").select("key", row.alias("row"), F.coalesce("component", "id").alias("component")), "placed")
        spread = placed.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most").select("key", "least")
        unsettled = placed.join(spread.select("key"), "key")
        if turn < pivots:
            # The pivot: in the first turn the heaviest id, then the heaviest outside that one's component.
            left = _heaviest(unsettled)
            if turn:
                main = left.select("key", F.col("of").alias("main"))
                left = _heaviest(unsettled.join(main, "key").where("component <> main").drop("main"))
        else:
            left = unsettled.select("key", F.col("row").alias("left"), F.col("component").alias("of"))
        open_pairs = left.join(placed, "key").where(F.col("of") != F.col("component"))
        if turn == pivots:
            open_pairs = open_pairs.where(F.col("left.id") < F.col("row.id"))
            if "keys" in lists.columns:
                open_pairs = open_pairs.where(F.array_min(F.array_intersect("left.keys", "row.keys")) == F.col("key"))
        open_pairs = open_pairs.where(may_link(F.col("left"), F.col("row")))
        pairs = materialise(open_pairs.select(F.least("left.id", "row.id").alias("a"), F.greatest("left.id", "row.id").alias("b")).distinct(), "pairs")
        discard(placed)
        if not pairs.isEmpty():
            founds.append(materialise(verify(pairs), "found"))
            before, known = known, components(reduce(DataFrame.union, founds))
            if before is not None:
                discard(before)
        discard(pairs)
    discard(lists, *founds)
    kind = lists.schema["id"].dataType.simpleString()
    return known if known is not None else lists.sparkSession.createDataFrame([], f"id {kind}, component {kind}")
