"""Running predicted and gold SQL.

``spark.sql`` can only be called on the driver, so this is the one place
where a driver loop is inherent: it runs each **distinct** (db, SQL) text once
(texts are streamed with ``toLocalIterator``, a few in flight at a time; their
outcomes are written out in portions), in a small thread pool.  Each result is
written as canonical cells to a folder of its own run under the shared
checkpoint folder, and everything after that - pairing, outcome flags, set/bag
comparison - is distributed (``quarry.operators.compare``).

Only queries run: a text that parses to a command (DDL, DML, SET, ...) is an
``error`` and nothing is executed.  Analysis and execution both run under the
time limit, by job tags: the jobs of a text that runs longer than ``timeout_s``
are cancelled.  Rows carry the run that wrote them, and only the run that
reported ``ok`` is read, so a late write of a cancelled run counts for nothing.
"""

from __future__ import annotations

import threading
import time
from collections import deque
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.cells import result_cells
from quarry.operators.compare import score_pairs
from quarry.session import scratch_path

OUTCOME_SCHEMA = "text_id string, status string, message string, n_cols int, seconds double, run string"
ROW_SCHEMA = "text_id string, row_no long, cells array<string>, run string"
OUTCOMES_AT_ONCE = 5000


def text_id(db: F.Column, sql: F.Column) -> F.Column:
    return F.md5(F.concat_ws("\u0001", F.coalesce(db, F.lit("")), F.coalesce(sql, F.lit(""))))


class NotAQuery(ValueError):
    """A text that would change something instead of reading."""


def parsed_query(spark: SparkSession, sql: str) -> None:
    """Raise unless ``sql`` parses to a query: the parsed plan is inspected
    and nothing in it may be a command or a statement such as INSERT."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    of = spark._jvm.java.lang.Class.forName
    bad = [of("org.apache.spark.sql.catalyst.plans.logical." + c) for c in ("Command", "ParsedStatement")]
    todo = [plan]
    while todo:
        node = todo.pop()
        if any(c.isInstance(node) for c in bad):
            raise NotAQuery(f"not a query: {node.nodeName()}")
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]


def _within(spark: SparkSession, tag: str, fn, timeout_s: float):
    """Run ``fn`` under a job tag; cancel its jobs after ``timeout_s``.
    Returns (status, value or message, seconds)."""
    sc = spark.sparkContext
    result = {}
    began = time.monotonic()

    def work():
        sc.setInterruptOnCancel(True)  # a cancelled text frees its task slots at once
        sc.addJobTag(tag)
        try:
            result["v"] = ("ok", fn())
        except Exception as e:  # noqa: BLE001 - any failure is an outcome
            result["v"] = ("error", str(e))
        finally:
            sc.removeJobTag(tag)

    t = threading.Thread(target=work, daemon=True)
    t.start()
    t.join(timeout_s)
    took = time.monotonic() - began
    if t.is_alive():
        sc.cancelJobsWithTag(tag)
        t.join(30)
        return "timeout", f"longer than {timeout_s}s", took
    return *result["v"], took


def _result_rows(df: DataFrame, tid: str) -> DataFrame:
    return result_cells(df).select(F.lit(tid).alias("text_id"), F.monotonically_increasing_id().alias("row_no"), "cells")


def _run_batch(spark: SparkSession, batch: list, out_dir: str, timeout_s: float, sink: str, run: str):
    """Analyse each text (errors found here need no job), then run all the
    analysed ones as one job; if that job fails or times out, run them one
    by one to find out which."""
    outcomes, ready = [], []

    def analysed(sql):
        parsed_query(spark, sql)
        return spark.sql(sql)

    for i, (tid, sql) in enumerate(batch):
        status, got, took = _within(spark, f"quarry-a{run}-{i}", lambda sql=sql: analysed(sql), timeout_s)
        if status == "ok":
            ready.append((tid, got, took))
        else:
            outcomes.append((tid, status, got, None, took, None))
    if not ready:
        return outcomes

    def write(items, path):
        if sink == "noop":
            for _, df, _ in items:
                df.write.format("noop").mode("overwrite").save()
            return
        u = None
        for tid, df, _ in items:
            r = _result_rows(df, tid)
            u = r if u is None else u.unionByName(r)
        u.write.parquet(path)

    status, msg, took = _within(spark, f"quarry-b{run}", lambda: write(ready, f"{out_dir}/run={run}"),
                                timeout_s * len(ready))
    if status == "ok":
        return outcomes + [(tid, "ok", None, len(df.columns), a + took / len(ready), run) for tid, df, a in ready]
    if len(ready) == 1:
        tid, _, a = ready[0]
        return outcomes + [(tid, status, msg, None, a + took, None)]
    for i, (tid, df, a) in enumerate(ready):
        own = f"{run}-{i}"
        st, m, took = _within(spark, f"quarry-b{own}", lambda tid=tid, df=df, own=own: write([(tid, df, 0)], f"{out_dir}/run={own}"),
                              timeout_s)
        ok = st == "ok"
        outcomes.append((tid, st, None if ok else m, len(df.columns) if ok else None, a + took, own if ok else None))
    return outcomes


def run_texts(spark: SparkSession, texts: DataFrame, register_db: Callable[[str], None] | None = None,
              timeout_s: float = 30.0, threads: int = 8, sink: str = "parquet", batch_size: int = 1):
    """Run every distinct ``texts(text_id, db, sql)``.

    Texts are executed ``batch_size`` at a time (one job per batch; 1 keeps a
    slow or failing text from holding others back), ``threads`` batches at
    once.  A text that timed out, or took more than half the limit, while others
    ran may only have waited for task slots: it is run once more on its own, and
    that run counts.
    Returns ``(outcomes, rows)``: ``outcomes(text_id, status, message, n_cols,
    seconds)`` with status ``ok``/``error``/``timeout``, and ``rows(text_id,
    row_no, cells)``."""
    out_dir, log_dir = scratch_path(spark, "results"), scratch_path(spark, "outcomes")
    batch, pending, slow, done = [], deque(), [], []
    runs = iter(range(1 << 62))
    db = None

    def note(results, last=False):
        done.extend(results)
        if len(done) >= OUTCOMES_AT_ONCE or last:
            spark.createDataFrame(done, OUTCOME_SCHEMA).coalesce(1).write.mode("append").parquet(log_dir)
            done.clear()

    def drain(left: int):
        """Wait until at most ``left`` batches are in flight."""
        while len(pending) > left:
            items, future = pending.popleft()
            got = future.result()
            # half the limit alone can make a pair too slow, so such a time must be the text's own
            late = {o[0] for o in got if o[1] == "timeout" or o[4] > timeout_s / 2 and threads > 1}
            slow.extend(x for x in items if x[0] in late)
            note([o for o in got if o[0] not in late])

    def settle():
        """Finish what is in flight, then run the slow ones alone."""
        drain(0)
        for x in slow:
            note(_run_batch(spark, [x], out_dir, timeout_s, sink, str(next(runs))))
        slow.clear()

    with ThreadPoolExecutor(max_workers=threads) as pool:
        def flush():
            if batch:
                pending.append((list(batch), pool.submit(_run_batch, spark, list(batch), out_dir, timeout_s, sink, str(next(runs)))))
                batch.clear()
                drain(2 * threads)

        for r in texts.select("text_id", "db", "sql").orderBy("db", "text_id").toLocalIterator():
            if register_db is not None and r["db"] != db:
                flush()
                settle()  # views change: finish this database first
                register_db(r["db"])
                db = r["db"]
            batch.append((r["text_id"], r["sql"] or ""))
            if len(batch) >= batch_size:
                flush()
        flush()
        settle()
    note([], last=True)
    log = spark.read.schema(OUTCOME_SCHEMA).parquet(log_dir)
    good = log.where("status = 'ok'").select("text_id", "run")
    if sink == "noop" or good.isEmpty():
        rows = spark.createDataFrame([], "text_id string, row_no long, cells array<string>")
    else:
        rows = (spark.read.schema(ROW_SCHEMA).parquet(out_dir).join(good, ["text_id", "run"], "left_semi")
                .select("text_id", "row_no", "cells"))
    return log.drop("run"), rows


def pair_texts(pairs: DataFrame) -> DataFrame:
    """Distinct texts of ``pairs(pair_id, db, pred_sql, gold_sql)``."""
    p = pairs.select(text_id(F.col("db"), F.col("pred_sql")).alias("text_id"), "db", F.col("pred_sql").alias("sql"))
    g = pairs.select(text_id(F.col("db"), F.col("gold_sql")).alias("text_id"), "db", F.col("gold_sql").alias("sql"))
    return p.unionByName(g).dropDuplicates(["text_id"])


def outcome_flags(pairs: DataFrame, outcomes: DataFrame, timeout_s: float | None = None) -> DataFrame:
    """``executable`` is 1 when both ran (a time-out counts as
    executable, quirk Q8); any error - the gold query's too (Q9, flagged
    ``gold_failed``) - makes it 0.  The limit holds for the two texts of a
    pair together: a pair whose run times sum to more is a time-out."""
    o = outcomes.select("text_id", "status", "seconds")
    j = (pairs.withColumn("_pt", text_id(F.col("db"), F.col("pred_sql")))
         .withColumn("_gt", text_id(F.col("db"), F.col("gold_sql")))
         .join(o.select(F.col("text_id").alias("_pt"), F.col("status").alias("pred_status"), F.col("seconds").alias("_ps")), "_pt", "left")
         .join(o.select(F.col("text_id").alias("_gt"), F.col("status").alias("gold_status"), F.col("seconds").alias("_gs")), "_gt", "left"))
    err = (F.col("pred_status") == "error") | (F.col("gold_status") == "error")
    tmo = (F.col("pred_status") == "timeout") | (F.col("gold_status") == "timeout")
    if timeout_s is not None:
        tmo = tmo | ((F.col("_pt") != F.col("_gt")) & (F.col("_ps") + F.col("_gs") > timeout_s))
    return j.select("pair_id", "_pt", "_gt", "pred_status", "gold_status",
                    F.when(err, "error").when(tmo, "timeout").otherwise("ok").alias("outcome"),
                    F.when(err, 0).otherwise(1).alias("executable"),
                    (F.col("gold_status") == "error").alias("gold_failed"))


def evaluate_pairs(spark: SparkSession, pairs: DataFrame, register_db=None, timeout_s: float = 30.0,
                   threads: int = 4) -> DataFrame:
    """E3-E6 for ``pairs(pair_id, db, pred_sql, gold_sql)``:
    ``(pair_id, ex_eq, ex_bird, executable, outcome, gold_failed)``."""
    outcomes, rows = run_texts(spark, pair_texts(pairs), register_db, timeout_s, threads)
    return score_runs(pairs, outcomes, rows, timeout_s)


def score_runs(pairs: DataFrame, outcomes: DataFrame, rows: DataFrame, timeout_s: float = 30.0) -> DataFrame:
    """The scores of :func:`evaluate_pairs` for texts that have run.

    Results are compared once per distinct (predicted, gold) text pair: a gold
    text that many pairs share is not copied for each of them."""
    flags = outcome_flags(pairs, outcomes, timeout_s).withColumn("_key", F.xxhash64("_pt", "_gt"))
    both = flags.where(F.col("outcome") == "ok").select(F.col("_key").alias("pair_id"), "_pt", "_gt").distinct()
    sides = both.select("pair_id", F.explode(F.array(
        F.struct(F.lit("pred").alias("side"), F.col("_pt").alias("text_id")),
        F.struct(F.lit("gold").alias("side"), F.col("_gt").alias("text_id")))).alias("s")).select("pair_id", "s.*")
    counts = rows.groupBy("text_id").agg(F.count(F.lit(1)).alias("n_rows"))
    heads = (sides.join(outcomes.select("text_id", "n_cols"), "text_id").join(counts, "text_id", "left")
             .select("pair_id", "side", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"), "n_cols"))
    scores = score_pairs(sides.join(rows, "text_id").select("pair_id", "side", "row_no", "cells"), heads)
    won = lambda c: F.when(F.col("outcome") == "ok", F.col(c)).otherwise(0).cast("int").alias(c)
    return (flags.join(scores.withColumnRenamed("pair_id", "_key"), "_key", "left")
            .select("pair_id", won("ex_eq"), won("ex_bird"), F.col("executable").cast("int").alias("executable"),
                    "outcome", "gold_failed"))


def dry_run(spark: SparkSession, texts: DataFrame, register_db=None, timeout_s: float = 10.0,
            threads: int = 4) -> DataFrame:
    """``(text_id, ok)`` - True when the text runs to completion within
    ``timeout_s`` (through the ``noop`` sink), else NULL."""
    outcomes, _ = run_texts(spark, texts, register_db, timeout_s, threads, sink="noop")
    return outcomes.select("text_id", F.when(F.col("status") == "ok", F.lit(True)).alias("ok"))
