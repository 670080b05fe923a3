import os

import pytest

from geodemand.plans.job import JobConfig, run

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_run_writes_outputs(spark, tmp_path):
    cfg = JobConfig(
        sf_dir=SF,
        out_dir=str(tmp_path / "out"),
        forecast_table="geodemand_job_test.sales_forecast",
        forest_trees=5,
        boost_iters=3,
    )
    out = run(spark, cfg)
    s = out["summary"]
    assert s["selected_model"] in ("linear_regression", "random_forest", "gradient_boosting")
    assert s["train_rows"] > 0 and s["valid_rows"] == 5 * 5  # five places, five held-out days each
    fc = out["forecast"]
    assert fc.count() == 50  # five places x ten days
    t = spark.table(cfg.forecast_table)
    assert t.count() == 50
    assert dict(t.dtypes)["date"] == "date" and dict(t.dtypes)["trained_at"] == "timestamp"
    assert spark.read.json(f"{cfg.out_dir}/metrics").count() == 3
    assert spark.read.option("header", True).csv(f"{cfg.out_dir}/sales_forecast_csv").count() == 50
    from geodemand.operators.ml import load_model

    assert load_model(f"{cfg.out_dir}/model") is not None
    for copy, rows in (("training_csv", s["train_rows"] + s["valid_rows"]), ("weather_forecast_csv", 50)):
        assert spark.read.option("header", True).csv(f"{cfg.out_dir}/{copy}").count() == rows
    # the saved model scores the same horizon from its CSV copy alone, without any training input
    from geodemand.plans.job import build_tables

    horizon = {"path": f"{cfg.out_dir}/weather_forecast_csv", "schema": build_tables(spark, JobConfig(sf_dir=SF))["horizon"].schema.toDDL()}
    again = run(spark, JobConfig(inputs={"horizon": horizon}, model_path=f"{cfg.out_dir}/model", model_name="kept", out_dir=str(tmp_path / "again")))
    assert _forecast(again) == _forecast(out) and again["metrics"] is None
    assert {r["model_name"] for r in again["forecast"].collect()} == {"kept"}
    assert sorted(os.listdir(tmp_path / "again")) == ["sales_forecast_csv", "weather_forecast_csv"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_build_tables_materialised_equals_lazy(spark, tmp_path):
    from geodemand.plans.job import build_tables

    lazy = build_tables(spark, JobConfig(sf_dir=SF))
    mat = build_tables(spark, JobConfig(sf_dir=SF, tables_db="geodemand_job_steps", tables_location=str(tmp_path)))
    def rows(df):  # double means may differ in the last bits: summation order
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())

    for k in ("customers", "sales", "weather", "training", "horizon"):
        assert rows(lazy[k]) == rows(mat[k]), k
    assert spark.catalog.tableExists("geodemand_job_steps.resolved_customers")


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_main_prints_one_summary(spark, capsys):
    import json

    from geodemand.plans.job import main

    main([json.dumps({"sf_dir": SF, "forest_trees": 3, "boost_iters": 2, "models": ["linear_regression"]})])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["selected_model"] == "linear_regression" and out["valid_rows"] == 25


SMALL = {"forest_trees": 3, "boost_iters": 2, "models": ["linear_regression"]}


def _forecast(out):
    return sorted((r["city"], r["state"], r["date"], round(r["sales_amount_pred"], 4)) for r in out["forecast"].collect())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_run_on_named_tables_and_files(spark, tmp_path):
    from geodemand.plans.job import _ROLES, build_tables

    want = _forecast(run(spark, JobConfig(sf_dir=SF, **SMALL)))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS geodemand_inputs LOCATION '{tmp_path}/db'")
    for name, role in _ROLES.items():
        role(spark, SF).write.mode("overwrite").saveAsTable(f"geodemand_inputs.{name}")
    tables = {name: f"geodemand_inputs.{name}" for name in _ROLES}
    assert _forecast(run(spark, JobConfig(inputs=tables, **SMALL))) == want
    ready = build_tables(spark, JobConfig(sf_dir=SF))
    files = {}
    for name in ("training", "horizon"):
        ready[name].write.option("header", True).csv(f"{tmp_path}/{name}")
        files[name] = {"table": "geodemand_inputs.absent", "path": f"{tmp_path}/{name}", "schema": ready[name].schema.toDDL()}
    assert _forecast(run(spark, JobConfig(inputs=files, **SMALL))) == want


def test_inputs_are_named_when_missing(spark):
    from geodemand.plans.job import job_input

    with pytest.raises(ValueError, match="orders"):
        job_input(spark, JobConfig(), "orders")
    spark.range(1).createOrReplaceTempView("thin_places")
    with pytest.raises(ValueError, match="center_lat"):
        job_input(spark, JobConfig(inputs={"places": "thin_places"}), "places")


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_demo_model_from_csv(spark, tmp_path, capsys):
    import json

    from geodemand.operators.features import effects_score
    from geodemand.operators.ml import DEMO_TARGET, load_model, train_demo
    from geodemand.plans.job import main, run_demo
    from geodemand.sources import roles

    days = effects_score(roles.demo_day(spark, SF), name=DEMO_TARGET)
    days.write.option("header", True).csv(f"{tmp_path}/days")
    got = run_demo(spark, f"{tmp_path}/days", f"{tmp_path}/out", trees=5)
    want = train_demo(days, trees=5)[1].first()
    assert (got["summary"]["train_rows"], got["summary"]["test_rows"]) == (want["train_rows"], want["test_rows"])
    assert load_model(f"{tmp_path}/out/model").transform(days).count() == days.count()
    assert spark.read.json(f"{tmp_path}/out/metrics").count() == 1
    days.drop("season", "is_rainy").write.option("header", True).csv(f"{tmp_path}/thin")
    with pytest.raises(ValueError, match="is_rainy, season"):
        run_demo(spark, f"{tmp_path}/thin")
    main([json.dumps({"demo_csv": f"{tmp_path}/days", "trees": 3})])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["train_rows"] == want["train_rows"]
