"""The clamp and the idle timeout of a stream against those of a table, over batches of any cut and a restart."""

import datetime
import random

import pytest
from cantolith.streaming.clamp import clamped, clamped_stream

GAP = datetime.timedelta(seconds=30)
WORDS = "doc_id long, word_idx long, ts timestamp, start_s double, end_s double"


def words(seed, docs=4, n=25):
    r = random.Random(seed)
    out = []
    for d in range(docs):
        t = datetime.datetime(2024, 1, 1)
        for k in range(n):
            t += datetime.timedelta(seconds=r.choice([1, 2, 5, 30, 31, 90]))
            a = (t - datetime.datetime(2024, 1, 1)).total_seconds() - r.choice([0, 3])
            timed = r.random() < 0.7
            out.append((d, k, t, a if timed else None, a + r.randrange(1, 8) if timed else None))
    return out


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset(name)


def test_stream_equals_table(spark, rocks, tmp_path):
    data = words(1)
    order = sorted(data, key=lambda r: r[2])
    end = order[-1][2]
    r = random.Random(2)
    batches = [order[k : k + 30] for k in range(0, len(order), 30)]
    for b in batches:
        r.shuffle(b)
    late = (0, 99, order[0][2], 1.0, 2.0)  # far behind the watermark by then: left out
    batches[-1].append(late)
    batches += [[(9, 0, end + datetime.timedelta(hours=1), None, None)], [(9, 1, end + datetime.timedelta(hours=2), None, None)]]
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def run():
        df = spark.readStream.schema(WORDS).option("maxFilesPerTrigger", 1).parquet(source)
        q = clamped_stream(df, GAP, "200 seconds").writeStream.format("parquet").option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start(out)
        q.awaitTermination()

    for k, b in enumerate(batches):
        spark.createDataFrame(b, WORDS).coalesce(1).write.mode("append").parquet(source)
        if k == 1 or k == len(batches) - 1:  # a restart between
            run()
    got = {tuple(x) for x in spark.read.parquet(out).where("doc_id < 9").collect()}
    want = {tuple(x) for x in clamped(spark.createDataFrame(data, WORDS), GAP).collect()}
    assert got == want and sum(x[1] == "idle" for x in want) > 10
    moved = [x for x in want if x[1] == "word" and x[4] is not None]
    assert any((d, k, a) not in {(x[0], x[1], x[3]) for x in data} for d, _, _, k, a, _ in moved)


def test_table_by_hand(spark):
    t = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)
    rows = [(1, 0, t(0), 0.0, 5.0), (1, 1, t(3), 3.0, 4.0), (1, 2, t(33), None, None), (1, 3, t(64), 64.0, 65.0), (2, 0, None, 1.0, 2.0)]
    got = {tuple(x) for x in clamped(spark.createDataFrame(rows, WORDS), GAP).collect()}
    assert got == {(1, "word", t(0), 0, 0.0, 5.0), (1, "word", t(3), 1, 5.0, 6.0), (1, "word", t(33), 2, None, None), (1, "idle", t(63), None, None, None), (1, "word", t(64), 3, 64.0, 65.0), (1, "idle", t(94), None, None, None)}
    assert clamped(spark.createDataFrame([], WORDS), GAP).count() == 0
