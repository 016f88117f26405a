"""Q13: timed runs and the run log.

The reference times ``SELECT *`` per table on several engines and keeps
``(table, rows, cols, engine, time_s)`` rows, ``time_s`` NULL on failure.
Here the "engine" axis becomes the *form* of one Spark query — ``sql``
(``spark.sql`` over a bound frame) and ``dataframe`` (the same plan from
the DataFrame API) — and each run executes the whole plan through the
``noop`` sink (no collection to the driver). The run log is a small
metadata frame (one row per timed run) that can be appended to a table and
read by ``reports.run_log_pivot`` / ``reports.run_log_summary``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

RUN_LOG_SCHEMA = "table string, rows long, cols int, engine string, time_s double, error string"

# The forms timed for each table, in report order.
FORMS = ("sql", "dataframe")


def form_of(spark: SparkSession, df: DataFrame, form: str) -> DataFrame:
    if form == "sql":
        return spark.sql("SELECT * FROM {data}", data=df)
    if form == "dataframe":
        return df.select("*")
    raise ValueError(f"unknown form {form!r}")


def timed(action: Callable[[], None]) -> tuple[float | None, str | None]:
    """Seconds taken by ``action``; ``(None, error class)`` if it fails."""
    t0 = time.perf_counter()
    try:
        action()
    except Exception as e:  # noqa: BLE001 - a failed run is recorded, not raised
        return None, type(e).__name__
    return time.perf_counter() - t0, None


def run_benchmark(
    spark: SparkSession, tables: Mapping[str, DataFrame], forms=FORMS, repeat: int = 1
) -> DataFrame:
    """Time every form of ``SELECT *`` on every table; return the run log.

    ``repeat`` > 1 keeps the best of that many runs (a failed run makes the
    entry NULL, as in the reference's single-run log)."""
    rows = []
    for name, df in tables.items():
        n_rows = df.count()
        n_cols = len(df.columns)
        for form in forms:
            q = form_of(spark, df, form)
            best, err = None, None
            for _ in range(max(1, repeat)):
                secs, err = timed(lambda q=q: q.write.format("noop").mode("overwrite").save())
                if secs is None:
                    best = None
                    break
                best = secs if best is None else min(best, secs)
            rows.append((name, n_rows, n_cols, form, best, err))
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


def timed_steps(
    spark: SparkSession, steps: Mapping[str, Callable[[], DataFrame]]
) -> tuple[DataFrame, dict[str, str]]:
    """Run named steps in order — each builds a DataFrame that is executed in
    full through the ``noop`` sink — and return the step log ``(step,
    time_s)`` plus the error class of any failed step (its time is NULL)."""
    timings: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name, build in steps.items():
        secs, err = timed(lambda b=build: b().write.format("noop").mode("overwrite").save())
        timings[name] = secs
        if err:
            errors[name] = err
    return step_log(spark, timings), errors


def step_log(spark: SparkSession, timings: Mapping[str, float]) -> DataFrame:
    """Step-timing map → ``(step, time_s, ord)`` frame (input of Q12);
    ``ord`` keeps the steps' insertion order."""
    rows = [(k, v, i) for i, (k, v) in enumerate(timings.items())]
    return spark.createDataFrame(rows, "step string, time_s double, ord int")
