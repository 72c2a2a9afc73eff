"""Incremental maintenance of tables: merges, checkpoints, late references, quarantine.

Merges are outer joins on null-safe keys; they return the merged rows with what happened to each (`action`), so the
caller writes them once. Keys must be unique on each side; `last_of_key` makes them so.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import first_per_key


def last_of_key(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Of rows with one key the last in order (a value that can be compared), and how many there were: one grouping, which
    combines before it shuffles."""
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), order).alias("_last"), F.count(F.lit(1)).alias("occurrences"))
    return best.select("_last.*", "occurrences")


def merge(old: DataFrame, new: DataFrame, keys: list[str], values: list[str], keep_old_where_null: bool = False, newer: str | None = None) -> DataFrame:
    """keys, values, action (insert, update, no_change, keep). With keep_old_where_null a new null never overwrites;
    with newer (a column among values) a row is only updated if its value there is later."""
    a = old.select(*keys, *values, F.lit(True).alias("_has")).alias("o")
    b = new.select(*keys, *values, F.lit(True).alias("_has")).alias("n")
    joined = a.join(b, reduce(and_, (F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys)), "full")
    in_old, in_new = F.col("o._has").isNotNull(), F.col("n._has").isNotNull()
    took = in_new if newer is None else in_new & (~in_old | F.coalesce(F.col(f"n.{newer}") > F.col(f"o.{newer}"), F.col(f"o.{newer}").isNull()))
    value = {v: F.when(took, F.coalesce(f"n.{v}", f"o.{v}") if keep_old_where_null else F.col(f"n.{v}")).otherwise(F.col(f"o.{v}")) for v in values}
    same = reduce(and_, (value[v].eqNullSafe(F.col(f"o.{v}")) for v in values))
    action = F.when(~in_new, "keep").when(~in_old, "insert").when(same, "no_change").otherwise("update")
    return joined.select(*(F.when(in_new, F.col(f"n.{k}")).otherwise(F.col(f"o.{k}")).alias(k) for k in keys), *(value[v].alias(v) for v in values), action.alias("action"))


def replace_children(old: DataFrame, new: DataFrame, parent: str) -> DataFrame:
    """Children of every parent that the new rows name are the new rows; all others stay."""
    return old.join(new.select(parent).distinct(), parent, "left_anti").unionByName(new, allowMissingColumns=True)


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old and those rows of new whose key it lacks (first of equals is any)."""
    fresh = new.dropDuplicates(keys).alias("n").join(old.select(*keys).alias("o"), reduce(and_, (F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys)), "left_anti")
    return old.unionByName(fresh, allowMissingColumns=True)


def stubs(references: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    """A row per reference that the known table lacks."""
    return references.select(F.col(key).alias(known_key)).where(F.col(known_key).isNotNull()).distinct().join(known.select(known_key), known_key, "left_anti").withColumn("is_stub", F.lit(True))


def changed_only(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """key, old_value, new_value where they differ, nulls included."""
    joined = old.select(key, F.col(value).alias("old_value")).join(new.select(key, F.col(value).alias("new_value")), key)
    return joined.where(~F.col("old_value").eqNullSafe(F.col("new_value")))


def date_chunks(ranges: DataFrame, start: str, end: str, days: int = 5, overlap: int = 1) -> DataFrame:
    """ranges (any columns, with a first and a last day) with chunk, chunk_start, chunk_end: each chunk starts `overlap` days
    into the end of the one before. A range that ends before it starts has no chunk."""
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    starts = ranges.where(first <= last).select("*", F.posexplode(F.sequence(first, last, F.expr(f"INTERVAL {days - overlap} DAYS"))).alias("chunk", "chunk_start"))
    return starts.withColumn("chunk_end", F.least(F.date_add("chunk_start", days - 1), last)).where((F.col("chunk") == 0) | (F.datediff("chunk_end", "chunk_start") >= overlap))


def date_chunks_backwards(ranges: DataFrame, start: str, end: str, days: int = 5, overlap: int = 1) -> DataFrame:
    """The same, newest first; the next chunk ends `overlap` days before this one starts (there is no common day)."""
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    ends = ranges.where(first <= last).select("*", F.posexplode(F.sequence(last, first, F.expr(f"INTERVAL -{days - 1 + overlap} DAYS"))).alias("chunk", "chunk_end"))
    return ends.withColumn("chunk_start", F.greatest(F.date_sub("chunk_end", days - 1), first))


def high_water_mark(df: DataFrame, created: str, modified: str, floor: str) -> DataFrame:
    """One row: the latest of both columns, at least floor."""
    return df.agg(F.greatest(F.max(created), F.max(modified), F.lit(floor).cast("timestamp")).alias("high_water_mark"))


def checkpoints(state: DataFrame, runs: DataFrame) -> DataFrame:
    """State table (module, until) after some runs (module, until): the later end of each module; new modules are added."""
    return state.select("module", "until").unionByName(runs.select("module", "until")).groupBy("module").agg(F.max("until").alias("until"))


def park_and_retry(queue: DataFrame, known: DataFrame, key: str, most_attempts: int = 5) -> DataFrame:
    """queue (record, key, attempts, resolved) after one more try: resolved where the reference exists by now; parked
    rows count an attempt until most_attempts, then are given up (state)."""
    have = known.select(F.col(key).alias("_known")).distinct()
    tried = queue.join(have, queue[key] == have["_known"], "left")
    due = ~F.col("resolved") & (F.col("attempts") < most_attempts)
    found = due & F.col("_known").isNotNull()
    out = tried.withColumns({"attempts": F.col("attempts") + due.cast("int"), "resolved": F.col("resolved") | found}).drop("_known")
    return out.withColumn("state", F.when(F.col("resolved"), "resolved").when(F.col("attempts") >= most_attempts, "given_up").otherwise("parked"))


def retried(children: DataFrame, parents: DataFrame, record: str, key: str, ts: str, every_seconds: int, most: int = 5) -> DataFrame:
    """record, key, attempts, state of rows that came before their parents did: a row is looked at when it comes and then every so
    many seconds, `most` times at most; it is resolved by the first look at or after its parent's time, else given up.
    The same as the stream of `streaming.incremental.retry_stream` gives once all has arrived. Rows without a key or a
    time are given up without a look."""
    came = parents.groupBy(F.col(key).alias("_key")).agg(F.min(F.col(ts).cast("timestamp_ntz")).alias("_came"))
    own = F.col(ts).cast("timestamp_ntz")
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    wait = (micros(F.col("_came")) - micros(own)) / F.lit(1_000_000 * every_seconds)
    looks = F.greatest(F.ceil(wait), F.lit(0)).cast("int")
    found = children.join(came, F.col(key) == F.col("_key"), "left")
    state = F.when(F.col("_came").isNotNull() & own.isNotNull() & (looks <= most), "resolved").otherwise("given_up")
    attempts = F.when(state == "resolved", looks).when(F.col(key).isNull() | own.isNull(), 0).otherwise(most)
    return found.select(record, key, attempts.cast("int").alias("attempts"), state.alias("state"))


def pending(items: DataFrame, key: str, modified: str, log: DataFrame, since: Column | None = None) -> DataFrame:
    """Items never completed, or modified after their last completed run; from `since` on, if given. log: key, status,
    completed_at."""
    done = log.where("status = 'complete'").groupBy(key).agg(F.max("completed_at").alias("_done"))
    open_ = items.join(done, key, "left").where(F.col("_done").isNull() | (F.col(modified) > F.col("_done"))).drop("_done")
    return open_ if since is None else open_.where(F.col(modified) >= since)


def run_states(log: DataFrame, key: str, as_of: Column, stale_hours: int) -> DataFrame:
    """The latest run of each key; in_progress for longer than stale_hours counts as failed."""
    last = first_per_key(log, [key], F.desc("started_at"), F.desc("run_id"))
    stale = (F.col("status") == "in_progress") & (F.unix_timestamp(as_of) - F.unix_timestamp("started_at") > stale_hours * 3600)
    return last.withColumn("status", F.when(stale, "failed").otherwise(F.col("status")))


def quarantined(failures: DataFrame, key: str, most: int, as_of: Column, stale_days: int) -> DataFrame:
    """Keys with at least `most` failures that are not older than stale_days."""
    fresh = failures.where(F.datediff(as_of, F.col("failed_at")) <= stale_days)
    return fresh.groupBy(key).agg(F.count(F.lit(1)).alias("attempts"), F.max("failed_at").alias("last_failure")).where(F.col("attempts") >= most)


def remap_dates(rows: DataFrame, key: str, mapping: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns overwritten by those of a legacy table where it has a value."""
    m = mapping.select(F.col(key).alias("_key"), *(F.col(src).alias(f"_{dst}") for dst, src in columns.items()))
    joined = rows.join(m, rows[key] == m["_key"], "left")
    return joined.select(*(F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in rows.columns))


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both, with the columns of either; what a side lacks is null."""
    return old.unionByName(new, allowMissingColumns=True)


def violations(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break a rule (a condition that must hold; null breaks it), with the names of those rules."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items())))
    return rows.withColumn("errors", broken).where(F.size("errors") > 0)
