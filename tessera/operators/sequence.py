"""order_sequence: the first orders of each customer, with the gap to the next.

Shared by the retention queries (cohorts, gap histogram, repeat rates,
order value by sequence, new customers per month). They only ever need a
customer's first ``depth`` orders, so the sequence is a top-k per customer:
``row_number() <= depth`` is planned as a partial WindowGroupLimit before the
shuffle, which bounds what any one customer sends through the exchange to
``depth`` rows per input partition. ``lead`` then runs on the same
partitioning and ordering (no second exchange or sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def order_sequence(fact_order: DataFrame, depth: int = 2, fulfilled_only: bool = True,
                   key: str = "customer_key", ts: str = "purchased_at",
                   tie: str = "order_id") -> DataFrame:
    """Rows with ``order_seq <= depth`` plus ``next_at`` / ``gap_days``.

    Order: ``ts`` then ``tie`` (deterministic for equal timestamps).
    ``next_at`` is the following order's time; it is exact for
    ``order_seq < depth`` and NULL on the last kept row.
    """
    if depth < 1:
        raise ValueError("depth must be >= 1")
    f = fact_order.filter(F.col("is_fulfilled")) if fulfilled_only else fact_order
    w = Window.partitionBy(key).orderBy(F.col(ts), F.col(tie))
    top = f.withColumn("order_seq", F.row_number().over(w)).filter(F.col("order_seq") <= depth)
    nxt = F.lead(ts).over(w)
    return (top.withColumn("next_at", F.when(F.col("order_seq") < depth, nxt))
               .withColumn("gap_days", F.datediff("next_at", ts)))
