"""Resources of jobs, rolled up by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import as_float
from ..storage import few


def job_resource_summary(metrics: DataFrame, allocated: DataFrame | None = None) -> DataFrame:
    """One row per rule: n, wall hours, cores and GB used and allocated, and the share used of what was allocated.

    metrics(rule, s, max_rss, mean_load or cpu_percent), numbers as text or numbers; what isn't a number counts as 0.
    allocated(rule, threads, mem_mb, pos): rules outside it have nothing allocated and come last by pos.
    """
    load = "mean_load" if "mean_load" in metrics.columns else "cpu_percent"
    number = lambda c: as_float(F.col(c).cast("string"))
    rows = metrics.select("rule", number("s").alias("s"), (number(load) / 100).alias("load"), (number("max_rss") / 1024).alias("gb"))
    by = rows.groupBy("rule").agg(F.count("*").alias("n"), *[f(c).alias(f"{c}_{n}") for c in ("s", "load", "gb") for n, f in (("mean", F.avg), ("max", F.max))])
    if allocated is not None:
        by = by.join(few(allocated), "rule", "left")
    else:
        by = by.withColumns({"threads": F.lit(None).cast("long"), "mem_mb": F.lit(None).cast("double"), "pos": F.lit(None).cast("long")})
    cores, ram = F.coalesce(F.col("threads").cast("long"), F.lit(0)), F.round(F.coalesce(F.col("mem_mb").cast("double"), F.lit(0.0)) / 1024, 3)
    used, mean_gb = F.round("load_mean", 3), F.round("gb_mean", 3)
    return by.select(
        "rule", "n", F.round(F.col("s_mean") / 3600, 3).alias("walltime_mean_h"), F.round(F.col("s_max") / 3600, 3).alias("walltime_max_h"), cores.alias("cpu_alloc_cores"), used.alias("cpu_used_mean_cores"), F.round("load_max", 3).alias("cpu_used_max_cores"),
        ram.alias("ram_alloc_gb"), mean_gb.alias("ram_used_mean_gb"), F.round("gb_max", 3).alias("ram_used_max_gb"), F.when(cores > 0, F.round(used / cores, 3)).alias("cpu_eff"), F.when(ram > 0, F.round(mean_gb / ram, 3)).alias("ram_eff"), F.coalesce(F.col("pos").cast("long"), F.lit(1 << 30)).alias("pos"),
    )
