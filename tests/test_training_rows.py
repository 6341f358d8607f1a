"""Training rows are written once, for the S10 query and the model queries, by a codec that finds repeats."""

from pyspark.sql import functions as F

from slotloom.plans.catalog import inputs, models, training


def test_training_rows_are_written_once(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame(
        [(i, 0, ["none", "status"][i % 2], f"t{i}", 0, "nonent", [float(i), 0.5], "extra") for i in range(40)],
        "doc_id long, sent_idx int, label string, text string, root_idx int, ent_label string, features array<double>, dep string")
    monkeypatch.setattr(inputs, "_STAGED", {})
    for name in ("labelled", "annotated", "vectors"):
        monkeypatch.setattr(training, name, lambda *_: None)
    monkeypatch.setattr(training, "annotations", lambda *_: type("A", (), {"docs": None, "sents": None}))
    monkeypatch.setattr(training.features, "describe", lambda *_: None)
    monkeypatch.setattr(training.features, "assemble", lambda *_: rows)
    monkeypatch.setattr(training, "scratch_path", lambda _, name: str(tmp_path / name))
    monkeypatch.setattr(inputs, "stage", lambda df, name: df.write.parquet(str(tmp_path / name)) or spark.read.parquet(str(tmp_path / name)))
    got = training.s10_write_training_rows(spark, "").collect()
    assert sorted((r.doc_id, r.label, r.text, r.ent_label, r.width) for r in got) == [
        (i, ["none", "status"][i % 2], f"t{i}", "nonent", 2) for i in range(40)]
    split = models._rows(spark, "")
    assert sorted(tuple(r.features) for r in split.collect()) == [(float(i), 0.5) for i in range(40)]
    assert split.filter("is_train").count() + split.filter(~F.col("is_train")).count() == 40
    assert [p.name for p in tmp_path.iterdir()] == ["training_rows"]  # one copy of the features
    files = list((tmp_path / "training_rows").rglob("*.parquet"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)
    assert {f.parent.name for f in files} == {"label=none", "label=status"}
