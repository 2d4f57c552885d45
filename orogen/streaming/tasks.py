"""Queues and task graphs as relations: leases of messages, verdicts, passes, and tasks that wait for others.

Every step is a function of tables to tables, so that a service applies it to a stream's
micro-batches (``each_batch``) and a test to a fixed one.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

QUEUE = "id string, body string, sent long, receives int, hidden_until long"


def dequeue(queue: DataFrame, now: int, most: int, lease: int) -> tuple[DataFrame, DataFrame]:
    """(taken, queue after): the ``most`` oldest visible messages, hidden for ``lease`` seconds and counted once more."""
    taken = queue.where(F.col("hidden_until") <= now).orderBy("sent", "id").limit(most).select("id").withColumn("__t", F.lit(True))
    after = queue.join(taken, "id", "left")
    hit = F.coalesce("__t", F.lit(False))
    after = after.withColumns({"receives": F.col("receives") + hit.cast("int"), "hidden_until": F.when(hit, F.lit(now + lease)).otherwise(F.col("hidden_until")), "__t": hit})
    return after.where("__t").drop("__t"), after.drop("__t")


def enqueue(queue: DataFrame, messages: DataFrame, now: int) -> DataFrame:
    """``queue`` with new messages (id, body), visible at once; an id that is there already stays as it is."""
    new = messages.join(queue.select("id"), "id", "left_anti").select("id", "body", F.lit(now).cast("long").alias("sent"), F.lit(0).alias("receives"), F.lit(now).cast("long").alias("hidden_until"))
    return queue.unionByName(new)


def extend_leases(queue: DataFrame, held: DataFrame, now: int, lease: int) -> DataFrame:
    """The heartbeat of a worker: its messages (id) stay hidden for another ``lease``."""
    mine = held.select("id").distinct().withColumn("__h", F.lit(True))
    return queue.join(mine, "id", "left").withColumn("hidden_until", F.when(F.col("__h"), F.lit(now + lease).cast("long")).otherwise(F.col("hidden_until"))).drop("__h")


def acknowledge(queue: DataFrame, done: DataFrame) -> DataFrame:
    return queue.join(done.select("id").distinct(), "id", "left_anti")


def decoded(messages: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """(messages with their JSON body as ``message``, those whose body cannot be read)."""
    read = messages.withColumn("message", F.from_json("body", schema + ", __bad string", {"columnNameOfCorruptRecord": "__bad"}))
    good = F.col("message").isNotNull() & F.col("message.__bad").isNull()
    return read.where(good), messages.join(read.where(~good | F.col("message").isNull()).select("id"), "id", "left_semi")


def verdicts(messages: DataFrame, now: int, rejected: Column, max_age: int = 24 * 3600, max_receives: int = 3) -> DataFrame:
    """``messages`` with what a service does next: reject, expire, fail or handle."""
    age = F.lit(now) - F.col("sent")
    return messages.withColumn("verdict", F.when(F.coalesce(rejected, F.lit(False)), "reject").when(age > max_age, "expire").when(F.col("receives") > max_receives, "fail").otherwise("handle"))


def overdue(running: DataFrame, now: int, max_seconds: int, max_bytes: int | None = None) -> DataFrame:
    """The watchdog: workers (started, bytes) to be stopped, with the reason."""
    late = F.lit(now) - F.col("started") > max_seconds
    reason = F.when(late, "time")
    if max_bytes is not None:
        reason = reason.when(F.col("bytes") > max_bytes, "memory")
    return running.withColumn("reason", reason).where("reason is not null")


def event_urls(events: DataFrame) -> DataFrame:
    """Rows (id, url, event) of storage notifications, wrapped once or twice in JSON (bodies with a ``Message`` or ``Records``)."""
    record = "struct<Records:array<struct<eventName:string,s3:struct<bucket:struct<name:string>,object:struct<key:string>>>>>"
    inner = F.coalesce(F.get_json_object("body", "$.Message"), F.col("body"))
    found = events.select("id", F.explode(F.from_json(inner, record)["Records"]).alias("r"))
    key = F.url_decode(F.col("r.s3.object.key"))
    return found.select("id", F.concat(F.lit("s3://"), F.col("r.s3.bucket.name"), F.lit("/"), key).alias("url"), F.col("r.eventName").alias("event"))


def latent_marks(marks: DataFrame, changes: DataFrame, keys: list[str], debounce: int) -> DataFrame:
    """End-of-pass marks (keys, at) that fire ``debounce`` seconds later: those that no newer change of their keys overtakes."""
    newer = marks.join(changes.select(*keys, F.col("at").alias("__c")), keys, "left").groupBy(*keys, "at").agg(F.bool_or((F.col("__c") > F.col("at")) & (F.col("__c") <= F.col("at") + debounce)).alias("__late"))
    return newer.where(~F.coalesce("__late", F.lit(False))).select(*keys, "at", (F.col("at") + debounce).alias("fires"))


def latent_marks_stream(events: DataFrame, debounce_ms: int, lateness: str) -> DataFrame:
    """``latent_marks`` over a stream (key string, at timestamp, kind 'change' or 'mark'): rows (key, at, fires).

    The state of a key is its pending mark; a newer event drops it, the watermark's passing its time emits it.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        made = []
        pending = state.get[0] if state.exists else None
        if state.hasTimedOut:
            made.append(pending)
            state.remove()
            pending = None
        else:
            for pdf in batches:
                for at, kind in sorted(zip(pdf["at"].astype("int64") // 1_000_000 if pdf["at"].dtype == "datetime64[ns]" else pdf["at"].astype("datetime64[ms]").astype("int64"), pdf["kind"], strict=True)):
                    if pending is not None and at >= pending + debounce_ms:
                        made.append(pending)
                        pending = None
                    if kind == "mark" and (pending is None or at > pending):
                        pending = int(at)
                    elif kind != "mark" and pending is not None and at > pending:
                        pending = None
            if pending is None:
                if state.exists:
                    state.remove()
            else:
                state.update((pending,))
                state.setTimeoutTimestamp(max(pending + debounce_ms, state.getCurrentWatermarkMs() + 1))
        if made:
            yield pd.DataFrame({"key": [key[0]] * len(made), "at": pd.to_datetime(made, unit="ms"), "fires": pd.to_datetime([m + debounce_ms for m in made], unit="ms")})

    timed = events.withWatermark("at", lateness)
    return timed.groupBy("key").applyInPandasWithState(run, "key string, at timestamp, fires timestamp", "pending long", "append", GroupStateTimeout.EventTimeTimeout)


def bounded_passes(passes: DataFrame, keys: list[str], capacity: int, seconds: int) -> DataFrame:
    """``passes`` (keys, at, id) with started, or null for those that found ``capacity`` others waiting; a pass takes ``seconds``.

    Each service's passes are replayed in order; a service has few passes a day.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["at", "id"])
        starts: list[int] = []
        out: list[int | None] = []
        for at in pdf["at"].tolist():
            waiting = sum(s > at for s in starts[-capacity - 1 :])
            if waiting >= capacity:
                out.append(None)
                continue
            starts.append(max(at, starts[-1] + seconds) if starts else at)
            out.append(starts[-1])
        return pdf.assign(started=pd.array(out, "Int64"))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in passes.schema]
    return passes.groupBy(*keys).applyInPandas(run, ", ".join([*fields, "started long"]))


def tileset_state(tilesets: DataFrame, now: int, zombie_after: int = 6 * 3600) -> DataFrame:
    """Rows with state: done, processing or zombie (by the age of the PID file), found or absent; from (has_files, is_done, pid_at)."""
    state = F.when(F.col("is_done"), "done").when(F.lit(now) - F.col("pid_at") > zombie_after, "zombie").when(F.col("pid_at").isNotNull(), "processing").when(F.col("has_files"), "found").otherwise("absent")
    return tilesets.withColumn("state", state)


def next_versions(wanted: DataFrame, taken: DataFrame, keys: list[str]) -> DataFrame:
    """``wanted`` (keys, id) with version: numbers after the greatest taken one of their keys, in the order of id."""
    top = taken.groupBy(*keys).agg(F.max("version").alias("__top"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("id"))
    return wanted.join(top, keys, "left").withColumn("version", F.coalesce("__top", F.lit(0)) + place).drop("__top")


# --- graphs of tasks ---------------------------------------------------------------------------------------------------


def ready(tasks: DataFrame, needs: DataFrame, done: DataFrame) -> DataFrame:
    """Tasks (task) that have not run and whose needs (task, needs) are all done (task)."""
    finished = done.select("task").distinct()
    missing = needs.join(finished.withColumnRenamed("task", "needs"), "needs", "left_anti").select("task").distinct()
    return tasks.join(finished, "task", "left_anti").join(missing, "task", "left_anti")


def newly_ready(needs: DataFrame, done: DataFrame, latest: DataFrame) -> DataFrame:
    """Tasks (task) whose last missing need is among ``latest`` (task): what a completion sets free."""
    touched = needs.join(latest.select(F.col("task").alias("needs")), "needs", "left_semi").select("task").distinct()
    return ready(touched, needs, done.select("task").union(latest.select("task")))


def current_status(log: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, task, status, since) of a log (keys, task, status, at): what still runs; done and failed tasks are gone."""
    last = log.groupBy(*keys, "task").agg(F.max_by("status", F.struct("at", "status")).alias("status"), F.max("at").alias("since"))
    return last.where(~F.col("status").isin("done", "error"))


def project_status(log: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, state, error): failed with the first error, done when the task '' is, else running."""
    first = F.min(F.when(F.col("status") == "error", F.struct("at", "message")))
    out = log.groupBy(*keys).agg(first.alias("e"), F.bool_or((F.col("status") == "done") & (F.col("task") == "")).alias("d"))
    return out.select(*keys, F.when(F.col("e").isNotNull(), "failed").when(F.col("d"), "done").otherwise("running").alias("state"), F.col("e.message").alias("error"))


def long_running(log: DataFrame, keys: list[str], now: int, seconds: int) -> DataFrame:
    return current_status(log, keys).withColumn("age", F.lit(now) - F.col("since")).where(F.col("age") > seconds)


def to_chunk(inputs: DataFrame, chunked: DataFrame) -> DataFrame:
    """Inputs (project, input) still to be cut up: the fan-out."""
    return inputs.join(chunked.select("project", "input").distinct(), ["project", "input"], "left_anti")


def chunking_done(inputs: DataFrame, chunked: DataFrame) -> DataFrame:
    """Projects whose inputs are all cut up: the fan-in."""
    open_ = to_chunk(inputs, chunked).select("project").distinct()
    return inputs.select("project").distinct().join(open_, "project", "left_anti")


def run_in_order(tasks: DataFrame, needs: DataFrame, work: Callable[[DataFrame], DataFrame], rounds: int = 1000) -> DataFrame:
    """Every task once, those that are ready together, until none is left; ``work``: ready tasks to rows with a task column.

    Rows (round and what ``work`` returns). Raises if tasks wait for each other.
    """
    from ..operators.graph import cut

    done, results = tasks.limit(0).select("task"), None
    left = tasks.count()
    for number in range(rounds):
        if not left:
            break
        now = cut(ready(tasks, needs, done))
        n = now.count()
        if not n:
            raise ValueError(f"{left} tasks wait for each other")
        made = cut(work(now).withColumn("round", F.lit(number)))
        results = made if results is None else results.unionByName(made)
        done = cut(done.union(now.select("task")))
        left -= n
    return results


def each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """``handle`` every micro-batch available, once for each batch number under the checkpoint."""
    stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def dispatch(handlers: dict[str, Callable[[DataFrame], DataFrame]], messages: DataFrame) -> dict[str, DataFrame]:
    """Messages (kind, ...) by handler; those of unknown kinds come back under ''."""
    out = {kind: handle(messages.where(F.col("kind") == kind)) for kind, handle in handlers.items()}
    return out | {"": messages.where(~F.col("kind").isin(*handlers) | F.col("kind").isNull())}


def message_body(kind: str, **fields: object) -> str:
    return json.dumps({"kind": kind, **{k: v for k, v in fields.items() if v is not None}}, sort_keys=True)
