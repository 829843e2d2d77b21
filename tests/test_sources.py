"""Sources and sinks (A1-A7, A10-A13) on files written by the tests."""

import json
import os

from ledgerlens import fixtures as fx
from ledgerlens.functions import feature_table
from ledgerlens.sources import persist, readers, writers

SF = "/root/testdata/sf0.001"


def test_invoice_lines_csv_round_trip(spark, tmp):
    lines = fx.invoice_lines_nulls(spark, SF)
    writers.write_table(lines, f"{tmp}/lines", "csv")
    back = readers.scan_invoice_lines(spark, f"{tmp}/lines")
    assert back.count() == lines.count()
    assert back.schema.names == lines.schema.names
    a = sorted(lines.fillna({"Inv_Amt": -1.0}).collect())
    b = sorted(back.fillna({"Inv_Amt": -1.0}).collect())
    assert [r.Inv_Id for r in a] == [r.Inv_Id for r in b]
    assert sum(1 for r in b if r.Vendor_Code is None) == sum(1 for r in a if r.Vendor_Code is None)


def test_json_in_csv(spark, tmp):
    path = f"{tmp}/batch.csv"
    doc = {"invoice": {"seller_name": "Acme, Inc.", "client_name": "Bob \"B\""},
           "items": [{"description": "line one\nline two", "quantity": "2", "total_price": "3.50"}]}
    with open(path, "w", encoding="utf-8") as f:
        f.write('File Name,Json Data\n')
        f.write('a.png,"' + json.dumps(doc).replace('"', '""') + '"\n')
        f.write('b.png,"{not json"\n')
    df = readers.scan_invoice_json_csv(spark, path)
    rows = {r.file_name: r for r in feature_table(df).collect()}
    assert rows["a.png"].seller_name == "Acme, Inc." and rows["a.png"].client_name == 'Bob "B"'
    assert rows["a.png"].total_items_price == 3.5
    assert rows["b.png"].num_items == 0


def test_json_files_and_jsonl_sink(spark, tmp):
    os.makedirs(f"{tmp}/docs")
    for i in range(3):
        with open(f"{tmp}/docs/d{i}.json", "w", encoding="utf-8") as f:
            json.dump({"invoice": {"seller_name": f"Straße {i}"}, "items": [], "_ocr_text": "x\ny"}, f, indent=2,
                      ensure_ascii=False)
    df = readers.scan_invoice_json_files(spark, f"{tmp}/docs")
    assert sorted(r.file_name for r in df.collect()) == ["d0.json", "d1.json", "d2.json"]
    parsed = df.select("file_name", __import__("ledgerlens").functions.parse_invoice_json("json_data").alias("_doc"))
    writers.write_invoice_json(parsed, f"{tmp}/out")
    text = "".join(open(os.path.join(f"{tmp}/out", p), encoding="utf-8").read()
                   for p in os.listdir(f"{tmp}/out") if p.endswith(".json"))
    assert "Straße 0" in text  # non-ASCII kept


def test_features_and_predictions_sinks(spark, tmp):
    f = feature_table(fx.invoice_docs(spark, SF))
    writers.write_features(f, f"{tmp}/features")
    back = spark.read.option("header", "true").csv(f"{tmp}/features")
    assert back.count() == f.count() and "combined_text" in back.columns
    sub = writers.submission(fx.fake_predictions(spark, SF).withColumnRenamed("y_pred", "Predicted_Category"))
    assert sub.columns == ["Inv_Id", "Product_Category"]


def test_pipeline_and_model_persistence(spark, tmp):
    from ledgerlens.plans.preprocess import FeaturePipeline, NotFittedError, prepare_test
    from ledgerlens.plans.train import train_logistic
    import pytest

    lines = fx.invoice_lines(spark, SF)
    with pytest.raises(NotFittedError):
        persist.save_pipeline(None, f"{tmp}/p")
    with pytest.raises(NotFittedError):
        prepare_test(lines, None)
    model = FeaturePipeline(max_features=200).fit(lines)
    persist.save_pipeline(model, f"{tmp}/p")
    loaded = persist.load_pipeline(spark, f"{tmp}/p")
    a = model.transform(lines).select("Inv_Id", "features").orderBy("Inv_Id").collect()
    b = loaded.transform(lines).select("Inv_Id", "features").orderBy("Inv_Id").collect()
    assert a == b  # save/load gives equal transforms

    feats = model.transform(lines)
    lr = train_logistic(feats, max_iter=5)
    persist.save_model(spark, lr, f"file://{tmp}/m", "logistic_regression", 0.5,
                       spark.createDataFrame([("logistic_regression", 0.5)], "model string, f1 double"))
    lr2, name, score, results = persist.load_model(spark, f"file://{tmp}/m")
    assert name == "logistic_regression" and score == 0.5 and results.count() == 1
    persist.save_model(spark, lr, f"{tmp}/m2", "logistic_regression", 0.5)
    assert persist.load_model(spark, f"{tmp}/m2")[3] is None
    assert loaded.settings["text_col"] == "Item_Description" and loaded.settings["seed"] == 42
    p1 = lr.transform(feats).select("prediction").collect()
    p2 = lr2.transform(feats).select("prediction").collect()
    assert p1 == p2

    persist.write_label_mapping(model.class_dict, f"{tmp}/labels")
    m = persist.read_label_mapping(spark, f"{tmp}/labels")
    assert dict(m.select("idx", "value").collect()) == dict(model.class_dict.select("idx", "value").collect())


def test_labels_scan(spark, tmp):
    lines = fx.invoice_lines(spark, SF).select("Inv_Id", "Product_Category")
    writers.write_table(lines, f"{tmp}/labels.csv", "csv")
    labels = readers.scan_labels(spark, f"{tmp}/labels.csv")
    s = readers.label_summary(labels).first()
    assert s.n_rows == lines.count() and s.n_classes == lines.select("Product_Category").distinct().count()


def test_predictions_csv_keeps_every_column(spark, tmp):
    df = spark.createDataFrame([("1", [("A", 0.75), ("B", None)], {"k": 1}, 0.75)],
                               "Inv_Id string, top array<struct<label:string,prob:double>>, m map<string,int>, c double")
    writers.write_predictions(df, f"{tmp}/pred")
    row = spark.read.option("header", "true").option("escape", '"').csv(f"{tmp}/pred").first()
    assert json.loads(row["top"]) == [{"label": "A", "prob": 0.75}, {"label": "B", "prob": None}]
    assert json.loads(row["m"]) == {"k": 1} and row["c"] == "0.75"


def test_lines_with_quoted_line_ends(spark, tmp):
    path = f"{tmp}/lines.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write('Inv_Id,Vendor_Code,GL_Code,Inv_Amt,Item_Description\n1,V,G,2.5,"two\nlines, one cell"\n2,V,G,3.5,plain\n')
    rows = readers.scan_invoice_lines(spark, path, labelled=False, multi_line=True).collect()
    assert [r.Inv_Id for r in rows] == ["1", "2"] and rows[0].Item_Description == "two\nlines, one cell"
