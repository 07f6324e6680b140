"""First-come first-served schedule of one server (or of many, by key)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.operators.scale import HOT_ROWS, largest_group, running


def schedule(
    arrivals: DataFrame, cutoff: float | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Start, end and wait of each job of ``arrivals`` (server, id, arrival, service).

    A job starts at its arrival or when the previous one ends, whichever is later.
    With S the running sum of service times, that recursion unrolls to
    ``end = S + max(arrival - (S - service))`` over the jobs so far. Jobs are taken in
    until the previous end reaches ``cutoff``.
    """
    order = ["arrival", "id"]
    sizes = largest_group(arrivals, ["server"])
    work = running(
        arrivals, ["server"], order, {"work": ("sum", F.col("service"))}, hot_rows, sizes
    )
    idle = F.col("arrival") - (F.col("work") - F.col("service"))
    late = running(work, ["server"], order, {"late": ("max", idle)}, hot_rows, sizes)
    end = F.col("work") + F.col("late")
    timed = late.select(
        *arrivals.columns,
        (end - F.col("service")).alias("start"),
        end.alias("end"),
        (end - F.col("service") - F.col("arrival")).alias("wait"),
    )
    if cutoff is None:
        return timed
    over = F.when(F.col("end") >= cutoff, 1).otherwise(0).cast("long")
    counted = running(timed, ["server"], order, {"over": ("sum", over)}, hot_rows, sizes)
    # the first job that ends at or after the cutoff was still let in
    let_in = (F.col("over") == 0) | ((F.col("over") == 1) & (F.col("end") >= cutoff))
    return counted.filter(let_in).drop("over")
