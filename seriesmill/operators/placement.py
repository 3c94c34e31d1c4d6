"""Which task works on which group, by cost: tasks are cut where the running cost passes equal shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TASK = "_task"
#: Groups are added up in this many blocks first, so that no task sees them all.
BLOCKS = 1024


def cost_tasks(costs: DataFrame, group: Sequence[str], n_tasks: int) -> DataFrame:
    """group, _task (from 0) of groups with a ``cost`` of 0 or more; a missing cost counts as 0.

    Each group goes to the task in whose share of the total its middle lies. A task then holds no more than
    its share and the half of one group on either side; a group is never divided.
    """
    blocked = costs.select(
        *group, F.coalesce(F.greatest(F.col("cost").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("cost"),
        F.pmod(F.xxhash64(*group), F.lit(BLOCKS)).alias("_block"),
    )
    sums = blocked.groupBy("_block").agg(F.sum("cost").alias("_sum"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # BLOCKS rows at most
    everything = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = sums.select("_block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0.0)).alias("_start"), F.sum("_sum").over(everything).alias("_total"))
    so_far = Window.partitionBy("_block").orderBy(*group).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("_start") + F.sum("cost").over(so_far) - F.col("cost") / 2
    share = F.coalesce(F.try_divide(middle, F.col("_total")), F.lit(0.0))
    task = F.least(F.floor(share * n_tasks).cast("int"), F.lit(n_tasks - 1))
    return blocked.join(starts, "_block").select(*group, task.alias(TASK))


def place_by_cost(rows: DataFrame, group: Sequence[str], n_tasks: int, cost: str = "n") -> DataFrame:
    """``rows`` with ``_task``, spread accordingly; ``cost`` is SQL over ``n``, the rows of a group.

    Groups of ``_task`` and ``group`` need no further shuffle. The rows are read twice, once for the counts.
    """
    costs = rows.groupBy(*group).agg(F.count("*").alias("n")).select(*group, F.expr(cost).alias("cost"))
    inner = [f"_group{i}" for i in range(len(group))]
    tasks = cost_tasks(costs, group, n_tasks).withColumnsRenamed(dict(zip(group, inner)))
    same = [F.col(g).eqNullSafe(F.col(i)) for g, i in zip(group, inner)]
    return rows.join(tasks, same).drop(*inner).repartitionById(n_tasks, F.col(TASK))
