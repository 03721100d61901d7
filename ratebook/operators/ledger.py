"""Crawl-ledger table operators (J1-J9): the job queue kept as data.

The ledger is derived from an append-only transition log (job_id, ts, seq,
transition, detail) instead of updated in place, so every operator is a
filter, an anti join or a per-job aggregate (partial maxima and sums: a job with
a third of all events is combined map-side). The folded state merges, so a
snapshot takes up new events without the old log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratebook.fixed import PRIORITY_ORDER, STALE_MINUTES
from ratebook.operators.joins import one_row_join

LEDGER_COLS = ["job_id", "source_name", "url", "source_type", "priority", "is_primary", "status",
               "retries", "max_retries", "content_path", "error", "created_at", "updated_at"]


def fold_state(events: DataFrame) -> DataFrame:
    """J4 state of a part of the transition log, one row per job: ordered
    structs of the last transition, the last failure and the last completion,
    the number of failures and the last time. Everything in it can be merged
    (:func:`merge_states`), so a log may be folded in parts, in any order.
    ``events``: (job_id, ts, seq, transition in {'in_progress', 'completed',
    'failed'}, detail), each event in one part."""
    o = [F.col("ts"), F.col("seq")]
    t = F.col("transition")
    each = events.select("job_id", F.struct(*o, t.alias("transition")).alias("last"),
                         F.when(t == "failed", F.struct(*o, "detail")).alias("failed"),
                         F.when(t == "completed", F.struct(*o, "detail")).alias("completed"),
                         (t == "failed").cast("long").alias("retries"), F.col("ts").alias("updated"))
    return _merged(each)


def _merged(states: DataFrame) -> DataFrame:
    return states.groupBy("job_id").agg(
        F.max("last").alias("last"), F.max("failed").alias("failed"), F.max("completed").alias("completed"),
        F.coalesce(F.sum("retries"), F.lit(0)).alias("retries"), F.max("updated").alias("updated"))


def merge_states(*states: DataFrame) -> DataFrame:
    """One state from the states of parts of a log: maxima and sums, combined
    before the shuffle; merging in any order gives the fold of the whole log."""
    every = states[0]
    for s in states[1:]:
        every = every.unionByName(s)
    return _merged(every)


def ledger_of(jobs: DataFrame, state: DataFrame, max_retries: int = 3) -> DataFrame:
    """Ledger rows from the first enqueue of each job and the folded
    state. ``jobs``: (job_id, source_name, url, source_type, priority,
    is_primary, created_at). Status = last transition (else 'pending'); retries
    = failures; error = detail of the last failure unless a completion came
    after it; content_path = detail of the last completion. Transitions update
    their job by id, whatever their time; those of ids that were never enqueued
    change nothing."""
    def at(c: str) -> Column:
        return F.struct(F.col(f"{c}.ts"), F.col(f"{c}.seq"))
    err = F.when(F.col("failed").isNotNull() & (F.col("completed").isNull() | (at("failed") > at("completed"))),
                 F.col("failed.detail"))
    return jobs.join(state, "job_id", "left").select(
        "job_id", "source_name", "url", "source_type", "priority", "is_primary",
        F.coalesce("last.transition", F.lit("pending")).alias("status"),
        F.coalesce("retries", F.lit(0)).cast("long").alias("retries"),
        F.lit(max_retries).cast("long").alias("max_retries"),
        F.col("completed.detail").alias("content_path"), err.alias("error"), "created_at",
        F.coalesce("updated", "created_at").alias("updated_at"))


def fold_transitions(jobs: DataFrame, events: DataFrame, max_retries: int = 3) -> DataFrame:
    """J4 in one go: the ledger of a whole log. Aggregated before the join: a
    job with many events is one row there."""
    return ledger_of(jobs, fold_state(events), max_retries)


def enqueue(ledger: DataFrame, sources: DataFrame, now: Column, ord_col: str = "ord",
            max_retries: int = 3) -> DataFrame:
    """Add sources whose url is not yet in the ledger (first by
    ``ord_col`` per url), as pending with 0 retries. Insert-or-ignore =
    per-url ``min_by`` + left anti join + union."""
    first = (sources.groupBy("url")
                    .agg(F.min_by(F.struct("job_id", "source_name", "source_type", "priority", "is_primary"),
                                  F.col(ord_col)).alias("s")))
    new = first.join(ledger.select("url"), "url", "left_anti")
    rows = new.select(
        F.col("s.job_id").alias("job_id"), F.col("s.source_name").alias("source_name"), "url",
        F.col("s.source_type").alias("source_type"), F.col("s.priority").alias("priority"),
        F.col("s.is_primary").alias("is_primary"), F.lit("pending").alias("status"),
        F.lit(0).cast("long").alias("retries"), F.lit(max_retries).cast("long").alias("max_retries"),
        F.lit(None).cast("string").alias("content_path"), F.lit(None).cast("string").alias("error"),
        now.alias("created_at"), now.alias("updated_at"))
    return ledger.select(*LEDGER_COLS).unionByName(rows)


def priority_rank(c: Column) -> Column:
    """high=1, medium=2, low=3, anything else NULL (sorts first ascending)."""
    expr = None
    for i, p in enumerate(PRIORITY_ORDER, start=1):
        expr = F.when(c == p, F.lit(i)) if expr is None else expr.when(c == p, F.lit(i))
    return expr


def pending(ledger: DataFrame) -> DataFrame:
    """Pending or failed jobs with retries left, by priority (unknown
    first), primary first, then job id (a distributed sort)."""
    return (ledger.filter(F.col("status").isin("pending", "failed") & (F.col("retries") < F.col("max_retries")))
                  .orderBy(priority_rank(F.col("priority")).asc_nulls_first(),
                           F.col("is_primary").desc(), F.col("job_id")))


def completed(ledger: DataFrame) -> DataFrame:
    """J3."""
    return ledger.filter(F.col("status") == "completed")


def reset_stale(ledger: DataFrame, now: Column, minutes: int = STALE_MINUTES) -> DataFrame:
    """in_progress jobs last updated strictly before now - minutes go
    back to pending (updated_at = now)."""
    stale = (F.col("status") == "in_progress") & (F.col("updated_at") < now - F.expr(f"INTERVAL {int(minutes)} MINUTES"))
    flagged = ledger.withColumn("__stale", stale)
    return (flagged.withColumn("status", F.when(F.col("__stale"), F.lit("pending")).otherwise(F.col("status")))
                   .withColumn("updated_at", F.when(F.col("__stale"), now).otherwise(F.col("updated_at")))
                   .drop("__stale"))


def record_parse(results: DataFrame) -> DataFrame:
    """Parse results (job_id, source_name, record_count, status) ->
    per job: results, records, failed results."""
    return results.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("results"),
        F.sum("record_count").cast("long").alias("records"),
        F.count_if(F.col("status") != "completed").alias("failed_results"))


def checkpoint_state(saves: DataFrame) -> DataFrame:
    """J7 state: the last save per stage as one ordered struct; the maximum of
    the states of parts is the state of the whole registry."""
    return saves.groupBy("stage").agg(F.max(F.struct("created_at", "seq", "data_path", "row_count")).alias("last"))


def merge_checkpoints(*states: DataFrame) -> DataFrame:
    """One state from the states of parts of the registry."""
    every = states[0]
    for s in states[1:]:
        every = every.unionByName(s)
    return every.groupBy("stage").agg(F.max("last").alias("last"))


def latest_of(state: DataFrame) -> DataFrame:
    """J7 rows (stage, data_path, row_count, created_at) of a state."""
    return state.select("stage", "last.data_path", "last.row_count", "last.created_at")


def latest_checkpoint(saves: DataFrame) -> DataFrame:
    """Checkpoint registry upserted by stage: the last save per stage."""
    return latest_of(checkpoint_state(saves))


def job_stats(ledger: DataFrame) -> DataFrame:
    """Jobs per status."""
    return ledger.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def with_now(df: DataFrame, now_df: DataFrame) -> DataFrame:
    """Attach a one-row ``now`` column."""
    return one_row_join(df, now_df.select(F.col(now_df.columns[0]).alias("__now")))
