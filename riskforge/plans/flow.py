"""The whole flow in one call: profile -> derive -> evaluate -> gate -> model -> report.

Returns a dict of DataFrames (and the model run). Heavy intermediate tables
are written under the shared checkpoint folder; everything else stays lazy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskforge.functions.columns import fround, label_binary
from riskforge.functions.templates import auto_features, clean_names
from riskforge.operators import evaluate as E
from riskforge.operators import prep as P
from riskforge.operators import profile as PR
from riskforge.operators import report as R
from riskforge.operators.derive import derive_table
from riskforge.operators.metrics import evaluate
from riskforge.operators.model import train_models
from riskforge.operators.split import split_model, split_psi
from riskforge.session import materialize
from riskforge.sources.readers import SPEC_SCHEMA
from riskforge.sources.sinks import derived_table_name, save_derived, save_model, save_results


def run(df: DataFrame, spec: list[dict] | None = None, target_col: str | None = None, id_col: str = "pid",
        time_col: str | None = "lend_tm", thresholds: dict | None = None, train: bool = True,
        name: str = "run", out_dir: str | None = None, gbt_params: dict | None = None) -> dict:
    """Run every step on ``df``; ``spec`` defaults to the rule-based features,
    ``target_col`` to the first label candidate of the profile. With ``out_dir``
    all result tables, the derived table and the best model with its feature
    list are written below it and ``artifacts`` lists them with their row counts."""
    prof = PR.profile(df, time_col=time_col, id_col=id_col).cache()
    target_col = PR.choose_target(prof, target_col)
    usable = PR.usable_fields(prof, target_col)
    if spec is None:
        numeric = [r["name"] for r in usable.where(F.col("col_type") == "numeric").orderBy("position").collect()]
        spec = auto_features(numeric)
    spec = clean_names(spec)
    names = [f["name"] for f in spec]
    sources = list(dict.fromkeys(s for f in spec for s in f.get("sources", [])
                                 if s not in (id_col, time_col, target_col)))

    derived = materialize(derive_table(df, spec, target_col, id_col, time_col), f"feat_derived_{name}")
    base = split_psi(derived, time_col, id_col).withColumn("_is_base", F.col("split") == "base").drop("split")
    ev = evaluate(base, names, target_col, time_col, id_col, thresholds=thresholds, base_col="_is_base",
                  write_input=False)
    src = evaluate(base, sources, target_col, time_col, id_col, thresholds=thresholds, base_col="_is_base",
                   write_input=False)
    summary = E.eval_summary(ev.features).cache()
    gate = E.model_gate(summary)
    out = {
        "profile": prof, "profile_summary": PR.profile_summary(df, prof, target_col), "usable_fields": usable,
        "derived": derived, "features": ev.features, "bins": ev.bins, "psi_bins": ev.psi_bins,
        "monthly": ev.monthly, "source_features": src.features,
        "iv_gain": E.iv_gain(ev.features, src.features, spec, df.sparkSession),
        "summary": summary, "gate": gate, "top_features": E.top_features(ev.features),
        "report_features": R.report_features(ev.features, spec, df.sparkSession),
    }
    run_ = None
    if train and gate.first()["train_model"]:
        selected = [r["feature"] for r in E.select_features(ev.features).orderBy("rank").collect()]
        frame = derived.withColumn("y", label_binary(F.col(target_col), derived.schema[target_col].dataType))
        frame = split_model(frame, time_col, id_col)
        rows = frame.where(F.col("split") == "train")
        out["train_gate"] = P.train_gate(rows)
        if out["train_gate"].first()["trainable"]:
            stats = P.fit_prep(rows, selected, frame)
            prepared = materialize(P.apply_prep(frame, selected, stats).select(id_col, "y", "split", *selected),
                                   f"{name}_model_input")
            run_ = train_models(prepared, selected, gbt_params=gbt_params)
            rate = rows.agg(fround(F.avg(F.col("y").cast("double")), 4)).first()[0]
            out.update(model_metrics=run_.metrics, importance=run_.importance,
                       report_models=R.report_models(run_, df.sparkSession, rate),
                       report_importance=R.report_importance(run_))
    out["report_headline"] = R.report_headline(summary, run_)
    if out_dir:
        out["artifacts"] = _write(out, spec, run_, out_dir.rstrip("/"), name)
    out["model_run"] = run_
    return out


def _write(out: dict, spec: list[dict], run_, out_dir: str, name: str) -> DataFrame:
    """Derived table under its forced prefix, every result table, the model and its feature list."""
    derived = out["derived"]
    spark = derived.sparkSession
    tables = {k: v for k, v in out.items() if k != "derived"}
    tables["feature_design"] = spark.createDataFrame([tuple(f[c] for c in SPEC_SCHEMA.names) for f in spec], SPEC_SCHEMA)
    if run_ is not None and run_.best:
        save_model(run_.models[run_.best], f"{out_dir}/model")
        tables["model_features"] = spark.createDataFrame(
            [(run_.best, i, f) for i, f in enumerate(run_.features)], "model string, position int, feature string")
    _, status = save_derived(derived, name, path=f"{out_dir}/{derived_table_name(name)}")
    return save_results(tables, out_dir).unionByName(
        status.select(F.col("table_name").alias("artifact"), F.col("row_count").alias("n_rows")))
