"""The whole flow on the smallest data set, spec read from JSON, sinks and model round trip."""

import json
import os

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_run_whole_flow(spark, tmp_path):
    from riskforge.plans import catalog as C
    from riskforge.plans.flow import run
    from riskforge.sources.readers import read_spec
    from riskforge.sources.sinks import load_model, save_model
    from riskforge.operators.model import SHORT_RUN, score

    path = tmp_path / "spec.json"
    path.write_text(json.dumps({"features": C.EVAL_SPEC}, ensure_ascii=False))
    spec = read_spec(spark, str(path))
    assert [f["name"] for f in spec] == [f["name"] for f in C.EVAL_SPEC]
    assert spec[0]["sources"] == ["sum_price", "sum_qty"]

    wide = C.wide(spark, SF)
    out = run(wide, spec, target_col="is_bad", name="t", out_dir=str(tmp_path / "out"), gbt_params=SHORT_RUN)
    feats = {r["feature"]: r for r in out["features"].collect()}
    assert set(feats) == {f["name"] for f in spec}
    assert out["summary"].first()["total"] == len(spec)
    assert out["derived"].where(F.col("is_bad").isNull()).count() == 0
    run_ = out["model_run"]
    assert run_ is not None
    test_auc = {r["model"]: r["auc"] for r in run_.metrics.where("split = 'test'").collect()}
    assert test_auc["gbt"] > 0.7 and test_auc["lr"] > 0.7
    assert out["report_headline"].first()["best_auc"] == max(test_auc.values())

    assert 0 < run_.rounds <= SHORT_RUN["rounds"] and out["train_gate"].first()["trainable"]
    cards = {r["model"]: r for r in out["report_models"].collect()}
    assert sum(r["is_best"] for r in cards.values()) == 1 and all(0 < r["positive_rate"] < 1 for r in cards.values())
    listed = {r["artifact"]: r["n_rows"] for r in out["artifacts"].collect()}
    assert listed["feat_derived_t"] == out["derived"].count() and listed["feature_design"] == len(spec)
    assert listed["model_features"] == len(run_.features) and listed["model_metrics"] == 4
    assert load_model(str(tmp_path / "out" / "model"))

    model_dir = str(tmp_path / "model")
    save_model(run_.models["lr"], model_dir)
    data = out["derived"].limit(50).select("pid", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                                          for c in run_.features])
    a = {r["pid"]: r["score"] for r in score(run_.models["lr"], data).collect()}
    b = {r["pid"]: r["score"] for r in score(load_model(model_dir), data).collect()}
    assert a == b


def test_registered_queries_train_the_default_rounds(monkeypatch):
    from riskforge.operators.model import GBT_PARAMS
    from riskforge.plans import catalog as C

    asked = []
    for name in ("wide", "prepared", "selected", "checkpoint_root"):
        monkeypatch.setattr(C, name, lambda *a: "")
    monkeypatch.setattr(C, "_memo", lambda spark, sf, what, fn: fn())
    monkeypatch.setattr(C, "train_models", lambda *a, gbt_params=None, **kw: asked.append(gbt_params))
    monkeypatch.setattr(C, "run", lambda *a, gbt_params=None, **kw: asked.append(gbt_params) or {"artifacts": None})

    class Session:
        class sparkContext:
            applicationId = "app"

    C.model_run(Session, "sf")
    C.q_run_flow(Session, "sf")
    assert [dict(GBT_PARAMS, **(p or {})) for p in asked] == [GBT_PARAMS, GBT_PARAMS]
    assert GBT_PARAMS["rounds"] == 500 and GBT_PARAMS["patience"] == 50


def test_derived_sink_prefix_and_status(spark, tmp_path):
    from riskforge.sources.sinks import derived_table_name, save_derived
    assert derived_table_name("db.my table") == "db.feat_derived_my_table"
    assert derived_table_name("feat_derived_x") == "feat_derived_x"
    df = spark.createDataFrame([(1, 2.0)], "pid long, x double")
    _, status = save_derived(df.where("pid < 0"), "empty", path=str(tmp_path / "e"))
    assert status.first()["status"] == "empty"
    back, status = save_derived(df, "one", path=str(tmp_path / "o"))
    assert (status.first()["row_count"], status.first()["status"]) == (1, "ok") and back.count() == 1
