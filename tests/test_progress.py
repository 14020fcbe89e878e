import time
from types import SimpleNamespace

from leakwatch.streaming import run


def test_counter_keeps_every_trigger():
    counter = run.RowCounter()
    for i in range(250):
        operator = SimpleNamespace(numRowsDroppedByWatermark=i % 2)
        counter.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(id="q", numInputRows=3, stateOperators=[operator])))
    assert (counter.triggers["q"], counter.seen["q"], counter.late["q"]) == (250, 750, 125)


def test_counter_hears_a_query(spark, tmp_path):
    spark.range(10).repartition(2).write.parquet(f"{tmp_path}/in")
    counter = run.RowCounter()
    spark.streams.addListener(counter)
    try:
        stream = spark.readStream.schema("id bigint").parquet(f"{tmp_path}/in")
        query = run.finish(run.to_table(stream, f"{tmp_path}/out", f"{tmp_path}/check"))
        for _ in range(50):
            if counter.seen[str(query.id)] == 10:
                break
            time.sleep(0.2)
        assert counter.seen[str(query.id)] == 10 and counter.late[str(query.id)] == 0
    finally:
        spark.streams.removeListener(counter)
