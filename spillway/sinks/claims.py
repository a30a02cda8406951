"""Claims: items of a queue table handed to many workers, each item to one of them.

A claim takes the next ``n`` items of one queue. It is an entry under the number after the queue's newest
claim, created at most once: of two workers that saw the same mark one creates it, and the other looks again
behind the new mark. An entry carries the mark, how many items were taken so far, and the ranges of the last claims by
their ids, so a worker that repeats a claim (its own crash, a lost answer) gets the same items and takes nothing more.

The depth of a queue needs no look at its items: pushes keep a total per queue (``record_pushes``),
claims keep another, and a probe reads the newest entry of each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.queue import FIFO_KEY, queue_pop
from ..plans.joins import lookup_join
from .entries import KEEP, Entries, folder_of, newest_of_each
from .queue_sink import path_exists, read_queue

ATTEMPTS = 100
MARKS = "queue string, mark struct<batch_id: bigint, pos: bigint>, taken bigint"


def _claims(spark: SparkSession, log: str, queue: str) -> Entries:
    return Entries(spark, f"{log}/{folder_of(queue)}")


def _after(mark: list[int] | None):
    key = F.struct(*FIFO_KEY)
    return F.lit(True) if mark is None else key > F.struct(*[F.lit(int(m)).cast("bigint").alias(c) for c, m in zip(FIFO_KEY, mark)])


def claim(spark: SparkSession, path: str, log: str, queue: str, n: int, claim_id: str,
          before_commit: Callable[[], None] | None = None) -> DataFrame:
    """The next ``n`` items of ``queue`` for ``claim_id``, which no other claim gets; fewer, or none, when fewer are left.

    ``before_commit`` runs between the look and the commit (tests put another worker's claim there).
    """
    items = read_queue(spark, path).where(F.col("queue") == queue)
    taken = claim_each(spark, log, [queue], claim_id, lambda marks: _next(items, {queue: n}, marks), before_commit)
    return _between(items, taken.get(queue))


def claim_all(spark: SparkSession, path: str, log: str, n: int, claim_id: str) -> DataFrame:
    """``claim`` for every queue of the table; one look for all queues, one commit for each."""
    items = read_queue(spark, path)
    queues = [r["queue"] for r in items.select("queue").distinct().collect()]  # one row a queue
    taken = claim_each(spark, log, queues, claim_id, lambda marks: _next(items, dict.fromkeys(marks, n), marks))
    spans = [(q, e["after"] and tuple(e["after"]), tuple(e["upto"])) for q, e in taken.items()]
    key = "struct<batch_id: bigint, pos: bigint>"
    ranges = spark.createDataFrame(spans, f"queue string, after {key}, upto {key}")
    rows = lookup_join(items, ranges, ["queue"], "inner", label="claim")
    own = F.struct(*FIFO_KEY)
    return rows.where((F.col("after").isNull() | (own > F.col("after"))) & (own <= F.col("upto"))).drop("after", "upto")


def _next(items: DataFrame, wanted: dict[str, int], marks: dict[str, list[int] | None]) -> dict[str, tuple[list[int], int]]:
    """(last key, number) of the next items of each queue: a top-n, one row a queue back."""
    ahead = F.lit(False)
    for queue, mark in marks.items():
        ahead = ahead | ((F.col("queue") == queue) & _after(mark))
    n = next(iter(wanted.values()))
    got = queue_pop(items.where(ahead), n).groupBy("queue").agg(F.max(F.struct(*FIFO_KEY)).alias("upto"), F.count(F.lit(1)).alias("n"))
    return {r["queue"]: (list(r["upto"]), r["n"]) for r in got.collect()}


def claim_each(spark: SparkSession, log: str, queues: Iterable[str], claim_id: str,
               look: Callable[[dict], dict], before_commit: Callable[[], None] | None = None) -> dict[str, dict]:
    """Commits a claim in every queue that has items; returns the ranges by queue. Queues that lost a commit are looked at again."""
    done: dict[str, dict] = {}
    waiting = list(queues)
    for _ in range(ATTEMPTS):
        newest = {q: _claims(spark, log, q).newest() for q in waiting}
        for q in list(waiting):
            repeated = newest[q][1].get("claims", {}).get(claim_id)
            if repeated:
                done[q] = repeated
                waiting.remove(q)
        if not waiting:
            return done
        found = look({q: newest[q][1].get("upto") for q in waiting})
        if before_commit is not None:
            before_commit()
        for q in list(waiting):
            number, entry = newest[q]
            if q not in found:
                waiting.remove(q)
                continue
            upto, n = found[q]
            own = {"after": entry.get("upto"), "upto": upto, "n": n, "number": number + 1}
            recent = {k: c for k, c in entry.get("claims", {}).items() if c["number"] > number - KEEP}
            if _claims(spark, log, q).put(number + 1, {"queue": q, "upto": upto, "taken": entry.get("taken", 0) + n,
                                                       "claims": {**recent, claim_id: own}}):
                done[q] = own
                waiting.remove(q)
        if not waiting:
            return done
    raise TimeoutError(f"claim {claim_id} lost {ATTEMPTS} commits in a row on {waiting}")


def _between(items: DataFrame, span: dict | None) -> DataFrame:
    if span is None:
        return items.where(F.lit(False))
    upto = F.struct(*[F.lit(int(m)).cast("bigint").alias(c) for c, m in zip(FIFO_KEY, span["upto"])])
    return items.where(_after(span["after"]) & (F.struct(*FIFO_KEY) <= upto))


def marks(spark: SparkSession, log: str) -> DataFrame:
    """(queue, mark, taken): newest mark of each queue and all that was taken so far."""
    rows = [(e["queue"], tuple(e["upto"]), e["taken"]) for e in newest_of_each(spark, log)]
    return spark.createDataFrame(rows, MARKS)


def unclaimed(spark: SparkSession, path: str, log: str) -> DataFrame:
    """Items that no claim has taken. One mark a queue: looked up, not shuffled."""
    rows = lookup_join(read_queue(spark, path), marks(spark, log).select("queue", "mark"), ["queue"], "left", label="marks")
    return rows.where(F.col("mark").isNull() | (F.struct(*FIFO_KEY) > F.col("mark"))).drop("mark")


def oldest_kept(spark: SparkSession, log: str) -> dict[str, list[int]]:
    """Per queue the key up to which no kept claim can be repeated: rows at or before it are never read again."""
    out = {}
    for entry in newest_of_each(spark, log):
        starts = [c["after"] for c in entry["claims"].values()]
        if None not in starts:
            out[entry["queue"]] = min(starts)
    return out


# --- depth ---------------------------------------------------------------------------------

def pushes_of(path: str) -> str:
    return f"{path}-pushes"


def record_pushes(spark: SparkSession, path: str, counts: Iterable[tuple[str, int, int]]) -> None:
    """Adds (queue, batch_id, items) to the totals. A batch that is written again replaces its own entry, whose total starts from
    the batch before it, so a replay counts once. Batches of a queue come in order (one writer a queue, see claim_writers)."""
    for queue, batch_id, n in counts:
        entries = Entries(spark, f"{pushes_of(path)}/{folder_of(queue)}")
        before = entries.newest(below=batch_id)[1].get("pushed", 0)
        entries.put(batch_id, {"queue": queue, "batch_id": batch_id, "n": n, "pushed": before + n}, replace=True)


def record_table(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Totals of a queue table that was written at once: one entry a queue, under its last batch."""
    counts = rows.groupBy("queue").agg(F.max("batch_id").alias("b"), F.count(F.lit(1)).alias("n")).collect()  # one row a queue
    record_pushes(spark, path, [(r["queue"], r["b"], r["n"]) for r in counts])


def kept_depth(spark: SparkSession, path: str, log: str, queue: str) -> int:
    """Items of one queue that no claim has taken: two small files, however old the table is."""
    pushed = Entries(spark, f"{pushes_of(path)}/{folder_of(queue)}").newest()[1].get("pushed", 0)
    return pushed - _claims(spark, log, queue).newest()[1].get("taken", 0)


def kept_depths(spark: SparkSession, path: str, log: str) -> DataFrame:
    """(queue, pushed, taken, depth) of every queue ever pushed to, from the kept totals alone."""
    pushed = {e["queue"]: e["pushed"] for e in newest_of_each(spark, pushes_of(path))}
    taken = {e["queue"]: e["taken"] for e in newest_of_each(spark, log)}
    rows = [(q, n, taken.get(q, 0), n - taken.get(q, 0)) for q, n in sorted(pushed.items())]
    return spark.createDataFrame(rows, "queue string, pushed bigint, taken bigint, depth bigint")


def has_totals(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, pushes_of(path))
