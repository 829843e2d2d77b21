"""K8: stateless scoring of arriving files with Structured Streaming (availableNow)."""

import pytest

from ledgerlens import fixtures as fx
from ledgerlens.plans.preprocess import FeaturePipeline
from ledgerlens.plans.score import predict_batch
from ledgerlens.plans.train import train_logistic
from ledgerlens.sources.writers import write_table
from ledgerlens.streaming.score_stream import batch_sink, start_scoring

SF = "/root/testdata/sf0.001"


def test_score_stream_matches_batch(spark, tmp):
    lines = fx.invoice_lines(spark, SF)
    model = FeaturePipeline(max_features=200).fit(lines)
    lr = train_logistic(model.transform(lines), max_iter=10)
    test = fx.invoice_lines_nulls(spark, SF).drop("Product_Category")
    write_table(test.repartition(3), f"{tmp}/in", "csv")
    q = start_scoring(spark, f"{tmp}/in", f"{tmp}/out", f"{tmp}/ckpt", model, lr)
    q.awaitTermination(600)
    out = spark.read.parquet(f"{tmp}/out")
    n_in = test.count()
    assert out.count() == n_in
    # Inv_Id is not unique at this scale, so compare multisets of rows.
    key = lambda r: (r.Inv_Id, r.Inv_Amt or 0.0, r.Predicted_Category, round(r.Confidence, 9))
    batch = sorted(map(key, predict_batch(test, model, lr).collect()))
    stream = sorted(map(key, out.collect()))
    assert batch == stream


def _fitted(spark):
    lines = fx.invoice_lines(spark, SF)
    model = FeaturePipeline(max_features=100).fit(lines)
    return model, train_logistic(model.transform(lines), max_iter=5), fx.invoice_lines_nulls(spark, SF).drop("Product_Category")


def _keys(df):
    return sorted((r.Inv_Id, r.Inv_Amt or 0.0, r.Predicted_Category, round(r.Confidence, 9)) for r in df.collect())


def test_restart_after_files_arrive_and_after_a_failed_batch(spark, tmp):
    model, lr, lines = _fitted(spark)
    halves = lines.randomSplit([0.5, 0.5], 1)
    write_table(halves[0].repartition(4), f"{tmp}/in", "csv")
    write, failed = batch_sink(f"{tmp}/out"), []

    def breaks_once(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after the write")

    def start(sink=None):
        out = f"{tmp}/out" if sink else f"{tmp}/file"
        return start_scoring(spark, f"{tmp}/in", out, f"{out}-ckpt", model, lr, max_files_per_trigger=1, sink=sink)

    with pytest.raises(Exception, match="lost after the write"):
        start(breaks_once).awaitTermination(600)
    assert failed == [1]
    start().awaitTermination(600)
    write_table(halves[1].repartition(3), f"{tmp}/in", "csv", mode="append")
    for sink in (breaks_once, None):
        q = start(sink)
        q.awaitTermination(600)
        assert q.exception() is None
    want = _keys(predict_batch(lines, model, lr))
    assert _keys(spark.read.parquet(f"{tmp}/out")) == want == _keys(spark.read.parquet(f"{tmp}/file"))
    start().awaitTermination(600)  # nothing new
    assert spark.read.parquet(f"{tmp}/file").count() == len(want)
    assert spark.read.parquet(f"{tmp}/out").select("batch_id").distinct().count() == 7  # one file a batch
