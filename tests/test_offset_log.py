import os

from topiclake.sources.offset_log import OffsetLog

DDL = "topic string, partition int, start_offset long, end_offset long, distinct_offsets long"


def put(spark, root, n, *spans):
    rows = [("t", 0, a, b, b - a + 1) for a, b in spans]
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("overwrite").parquet(f"{root}/log/batch={n}")


def log_of(root, fold=4):
    return OffsetLog(f"{root}/ranges", lambda n: f"{root}/log/batch={n}", fold=fold)


def spans(spark, log):
    return sorted((r.start_offset, r.end_offset) for r in log.read(spark).collect())


def test_what_is_opened_does_not_grow_with_the_log(spark, tmp_path):
    root = str(tmp_path)
    log = log_of(root)
    assert log.read(spark) is None
    for n in range(14):
        put(spark, root, n, (n * 10, n * 10 + 9)) if n != 6 else put(spark, root, n, (1000, 1004))
        log.written(spark, n)
        assert len(log.parts(spark)) <= 4
    assert spans(spark, log) == [(0, 59), (70, 139), (1000, 1004)]
    assert len(log.snapshots(spark)) == 2 and log.snapshots(spark)[-1] == 11


def test_a_batch_written_again_folds_again(spark, tmp_path):
    root = str(tmp_path)
    log = log_of(root, 2)
    for n in range(3):
        put(spark, root, n, (n * 10, n * 10 + 9))
        log.written(spark, n)
    put(spark, root, 3, (500, 509))
    log.written(spark, 3)
    put(spark, root, 3, (30, 39))
    log.written(spark, 3)
    assert spans(spark, log) == [(0, 39)]
    os.remove(f"{root}/ranges/upto=3/_SUCCESS")  # a fold that did not finish is not read
    assert spans(spark, log) == [(0, 39)] and log.snapshots(spark) == [1]


def test_batches_without_rows_and_with_gaps(spark, tmp_path):
    root = str(tmp_path)
    log = OffsetLog(f"{root}/ranges", lambda n: f"{root}/log/batch={n}", lambda n: f"{root}/begun/{n}", fold=3)
    for n in range(5):
        os.makedirs(f"{root}/begun/{n}")
        if n != 1:
            put(spark, root, n, (n * 10, n * 10 + 9))
        log.written(spark, n)
    spark.createDataFrame([("t", 0, 50, 59, 7)], DDL).write.parquet(f"{root}/log/batch=5")  # three offsets were never seen
    os.makedirs(f"{root}/begun/5")
    assert spans(spark, log) == [(0, 9), (20, 49)]
