"""Groups that fill up, that never do, and members that come too late, over several batches."""

import tempfile
import time
from datetime import datetime, timedelta

from wellspan.streaming import groups

START = datetime(2024, 1, 1)
KINDS = "plate string, size int, well string, ts timestamp"


def at(minutes):
    return START + timedelta(minutes=minutes)


def run(spark, batches, wait="60 minutes"):
    folder = tempfile.mkdtemp(prefix="timed-", dir="/tmp")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, KINDS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        time.sleep(1.1 if i + 1 < len(batches) else 0)  # files come in order of their times
    stream = spark.readStream.schema(KINDS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    with groups.timed(spark):
        groups.available_now(groups.timed_groups(stream, "plate", "size", "well", "ts", wait, "0 minutes"), f"{folder}/out", f"{folder}/state")
    return sorted((r.plate, r.members, r.n_members, r.size, r.complete) for r in spark.read.parquet(f"{folder}/out").collect())


def test_timed_groups(spark):
    batches = [
        [("a", 2, "A1", at(0)), ("b", 3, "B1", at(0)), ("b", 3, "B1", at(1)), ("c", 2, "C1", at(5)), (None, 1, "X", at(5)), ("d", 1, None, at(5))],
        [("a", 2, "A2", at(30)), ("b", 3, "B2", at(30))],
        [("a", 2, "A2", at(50)), ("e", 9, "E1", at(62))],  # b has run out, c is still open
        [("b", 3, "B3", at(63)), ("c", 2, "C2", at(64)), ("a", 2, "A3", at(64))],
        [("f", 2, "F1", at(100))],
    ]
    assert run(spark, batches) == [("a", "A1,A2", 2, 2, True), ("b", "B1,B2", 2, 3, False), ("c", "C1,C2", 2, 2, True), ("d", "", 0, 1, False)]


def test_keys_are_forgotten(spark):
    """After a second wait a key begins anew."""
    batches = [[("a", 1, "A1", at(0))], [("z", 9, "Z", at(125))], [("z", 9, "Z", at(126)), ("a", 1, "A9", at(126))]]
    assert run(spark, batches) == [("a", "A1", 1, 1, True), ("a", "A9", 1, 1, True), ("z", "Z", 1, 9, False)][:2]


def test_keys_share_states(spark):
    """Messages to the state do not grow with the keys: a state has one timer, whatever it holds."""
    folder = tempfile.mkdtemp(prefix="timed-", dir="/tmp")
    n = 3 * groups.STATES if hasattr(groups, "STATES") else 3_000
    spark.range(n).selectExpr("cast(id as string) plate", "2 size", "'A1' well", "timestamp_seconds(100000 + id) ts").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(KINDS).parquet(f"{folder}/in")
    with groups.timed(spark):
        made = groups.timed_groups(stream, "plate", "size", "well", "ts", "30 minutes", "0 minutes")
        q = made.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        q.awaitTermination()
    timers = max(p.stateOperators[0].customMetrics["numRegisteredTimers"] for p in q.recentProgress if p.stateOperators)
    assert 0 < timers <= 1024
    rows = spark.read.parquet(f"{folder}/out").collect()
    assert sorted(int(r.plate) for r in rows) == list(range(n - 1800)) and {(r.members, r.n_members, r.size, r.complete) for r in rows} == {("A1", 1, 2, False)}
