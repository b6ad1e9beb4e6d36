"""What keeps resolver_state's time in proportion to its input: few exchanges with the JVM for an id, and no batch written by one task."""

from collections import Counter

from pyspark.sql import Row
from pyspark.sql import functions as F

from framequarry.stateful_queries import _arrivals
from framequarry.streaming.resolver import Resolver


class Handle:
    """State and timers of one id in plain Python, with a count of the calls."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), Counter()

    def getValueState(self, *_):
        return self

    def __getattribute__(self, name):
        if name in ("exists", "get", "update", "clear", "listTimers", "registerTimer", "deleteTimer"):
            self.calls[name] += 1
        return object.__getattribute__(self, name)

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def listTimers(self):
        return iter(self.timers)

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_an_id_costs_few_calls_and_has_one_timer():
    handle, r = Handle(), Resolver(60.0, 3, None, True)
    r.init(handle)

    def batch(*rows):
        handle.calls.clear()
        out = list(r.handleInputRows(("a",), iter([Row(id="a", kind=k, ord=o, at=t) for k, o, t in rows]), None))
        return [(x.at, x.signal) for x in out], dict(handle.calls)

    assert batch(("sent", None, 1.0)) == ([], {"get": 1})
    assert batch(("ask", 7, 2.0)) == ([(2.0, "due")], {"get": 1, "update": 1})
    assert batch(("sent", None, 3.0)) == ([], {"get": 1, "update": 1, "registerTimer": 1})
    assert handle.timers == {63000}
    assert batch(("ask", 7, 4.0)) == ([], {"get": 1})
    # The timer has passed, and another one takes its place.
    assert batch(("sent", None, 70.5)) == ([(63.0, "due")], {"get": 1, "update": 1, "deleteTimer": 1, "registerTimer": 1})
    assert handle.timers == {130500}
    assert batch(("done", None, 80.0)) == ([], {"get": 1, "update": 1, "deleteTimer": 1})
    assert handle.timers == set()


def test_batches_arrive_whole_in_many_files(spark, tmp_path):
    rows = spark.range(1000).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("id"), (F.least(F.col("id"), F.lit(600)) / 200).cast("int").alias("b"))
    rows, seen = rows.withColumn("b", F.when(F.col("b") == 2, 3).otherwise(F.col("b"))), {}  # batch 2 is empty
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        stream = _arrivals(rows, F.col("b"), f"{tmp_path}/in")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert stream.columns == ["id", "b"] and len(list(tmp_path.glob("in/part-*.parquet"))) == 12

    def step(batch, number):
        seen[number] = {r.b: r.n for r in batch.groupBy("b").agg(F.count("*").alias("n")).collect()}

    stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    assert seen == {0: {0: 200}, 1: {1: 200}, 2: {}, 3: {3: 600}}
