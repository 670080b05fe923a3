"""The whole job: build the tables, train, choose, score, write.

Run on a cluster with ``spark-submit -m geodemand.plans.job`` style entry
(:func:`main`), or call :func:`run` with a session and a :class:`JobConfig`.
"""

from __future__ import annotations

import datetime as dt
import json
import sys
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import ml
from ..operators.features import place_labels
from ..operators.measures import Measure
from ..sources import roles
from .._cols import require_columns
from ..sources.io import coerce, read_source, write_csv, write_guarded, write_metrics, write_table
from .forecast import dow_profile_forecast
from .resolve import resolve_places
from .sales import place_day_sales
from .training import place_day_training
from .weather import PLACE_DAY_WEATHER, place_day_weather

# The typed columns of the written forecast table.
FORECAST_TABLE_SCHEMA = {
    "city": "string",
    "state": "string",
    "date": "date",
    "sales_amount_pred": "double",
    "model_name": "string",
    "trained_at": "timestamp",
}


# The job's inputs and the columns it needs of each.
INPUT_COLUMNS = {
    "customers": ("customer_id", "customer_name", "city", "state", "postcode", "loyalty_segment", "valid_from", "valid_to"),
    "target_places": ("target_city_norm", "target_state"),
    "orders": ("customer_id", "order_datetime", "ordered_products"),
    "weather": ("postal_code", "day", "lat", "lon"),
    "places": ("city", "state", "center_lat", "center_lon"),
    "training": ("city", "state", "date", ml.TARGET_COLUMN),
    "horizon": ("city", "state", "date"),
}


@dataclass
class JobConfig:
    sf_dir: str | None = None  # folder with the driver tables, for inputs that are not named below
    # Input name -> catalog table, or {"table": ..., "path": ..., "schema": DDL, "fmt": ...}: the table
    # if it exists, else the files. ``training`` and ``horizon`` given together skip the building steps.
    inputs: dict[str, str | dict] = field(default_factory=dict)
    date_from: str | None = None  # orders from this day on
    date_to: str | None = None  # orders up to this day
    out_dir: str | None = None  # model, metrics and CSV copies of the training, horizon and forecast rows go here when set
    model_path: str | None = None  # score the horizon with this saved model instead of training
    model_name: str = "saved"  # the name such a model's forecast carries
    forecast_table: str | None = None  # catalog table for the forecast
    max_km: float = 80.0
    year: int | None = 2024  # re-date sales into this month; None keeps their own days
    month: int | None = 1
    anchor: str = roles.HORIZON_ANCHOR.isoformat()
    horizon_days: int = 10
    valid_days: int = 5
    forest_trees: int = 400
    boost_iters: int = 100
    models: list[str] = field(default_factory=lambda: ["linear_regression", "random_forest", "gradient_boosting"])
    # Materialise each step as a table (the reference's step-by-step table
    # chain) under ``tables_db`` stored at ``tables_location`` (shared
    # storage); None keeps the job lazy but for the place-day weather, which is stored once.
    tables_db: str | None = None
    tables_location: str | None = None
    customer_buckets: int = 64


def _step(spark: SparkSession, cfg: JobConfig, df: DataFrame, table: str, **kw) -> DataFrame:
    """Write a step's output as a table and continue from the table, or pass
    the lazy frame through when no table location is configured."""
    if not cfg.tables_db:
        return df
    if not cfg.tables_location:
        raise ValueError("tables_db needs tables_location (a shared folder)")
    loc = f"{cfg.tables_location.rstrip('/')}/{cfg.tables_db}.db"
    name = f"{cfg.tables_db}.{table}"
    write_table(df, name, path=f"{loc}/{table}", schema_location=loc, **kw)
    return spark.table(name)


def job_input(spark: SparkSession, cfg: JobConfig, name: str) -> DataFrame:
    """A named input of the job, checked for its columns: the configured table or files, else the driver-table role."""
    given = cfg.inputs.get(name)
    if given is not None:
        spec = {"table": given} if isinstance(given, str) else given
        schema = T.StructType.fromDDL(spec["schema"]) if "schema" in spec else None
        df = read_source(spark, spec.get("table"), spec.get("path"), schema, spec.get("fmt", "csv"))
    elif cfg.sf_dir and name in _ROLES:
        df = _ROLES[name](spark, cfg.sf_dir)
    else:
        raise ValueError(f"The job needs the input {name!r}")
    require_columns(df, INPUT_COLUMNS[name], name)
    return df


_ROLES = {
    "customers": roles.customer_versions,
    "target_places": roles.target_places,
    "orders": roles.orders_json,
    "weather": roles.station_day,
    "places": roles.places,
}


def build_tables(spark: SparkSession, cfg: JobConfig) -> dict[str, DataFrame]:
    """Resolved customers, place-day sales and weather, training table and the
    weather horizon (lazy, or read back from tables when ``tables_db`` is
    set; customers are then bucketed by ``customer_id``)."""
    ready = ("horizon",) if cfg.model_path else ("training", "horizon")
    if set(ready) <= set(cfg.inputs):
        return {k: place_labels(job_input(spark, cfg, k)) for k in ready}
    get = lambda name: job_input(spark, cfg, name)
    customers = _step(
        spark,
        cfg,
        resolve_places(get("customers"), get("target_places")),
        "resolved_customers",
        bucket_by=(cfg.customer_buckets, ["customer_id"]),
    )
    sales = _step(
        spark,
        cfg,
        place_day_sales(get("orders"), customers, year=cfg.year, month=cfg.month, lo=cfg.date_from, hi=cfg.date_to),
        "place_day_sales",
    )
    weather = _step(
        spark, cfg, place_day_weather(get("weather"), get("places"), cfg.max_km), "place_day_weather"
    )
    if not cfg.tables_db:
        weather = ml.reliable_checkpoint(weather)  # place-days only; the training rows read it once, the horizon several times
    training = _step(spark, cfg, place_day_training(sales, weather), "training")
    measures = {n: Measure() for n in PLACE_DAY_WEATHER if n in weather.columns and n in ml.FEATURE_COLUMNS}
    places = weather.select("city", "state").distinct()
    horizon = _step(
        spark,
        cfg,
        # the same place names as the training rows, or the model would not know any place
        place_labels(
            dow_profile_forecast(
                weather, places, ["city", "state"], measures, dt.date.fromisoformat(cfg.anchor), cfg.horizon_days, date_col="date"
            )
        ),
        "weather_horizon",
    )
    return {"customers": customers, "sales": sales, "weather": weather, "training": training, "horizon": horizon}


def run(spark: SparkSession, cfg: JobConfig) -> dict[str, object]:
    """Build, split, train every candidate, keep the best, score the horizon
    and write the outputs that are configured. Returns the forecast frame, the
    metrics frame and the selection summary. With ``model_path`` nothing is
    trained (metrics: None): the saved model scores the horizon, and with only
    ``horizon`` among the inputs nothing else is read."""
    t = build_tables(spark, cfg)
    # cut both frames once: they are read many times below
    # cut once what is read many times below
    t = t | {"horizon": ml.reliable_checkpoint(t["horizon"])}
    if cfg.model_path:
        model, name, metrics = ml.load_model(cfg.model_path), cfg.model_name, None
        summary = {"selected_model": name, "mae": None, "r2": None, "train_rows": None, "valid_rows": None}
    else:
        t = t | {"training": ml.reliable_checkpoint(t["training"])}
        ml.require_known_places(t["horizon"], t["training"])
        sel = _train(t["training"], cfg)
        model, name, metrics = sel.model, sel.model_name, sel.metrics
        summary = {"selected_model": name, "mae": sel.mae, "r2": sel.r2, "train_rows": sel.train_rows, "valid_rows": sel.valid_rows}
    trained_at = dt.datetime.now(dt.timezone.utc).replace(microsecond=0, tzinfo=None)
    forecast = ml.score_forecast(model, t["horizon"]).withColumns({"model_name": F.lit(name), "trained_at": F.lit(trained_at)})
    if cfg.out_dir:
        if metrics is not None:
            ml.save_model(model, f"{cfg.out_dir}/model")
            write_metrics(metrics.withColumn("trained_at", F.lit(trained_at)), f"{cfg.out_dir}/metrics")
            write_csv(t["training"], f"{cfg.out_dir}/training_csv")
        write_csv(t["horizon"], f"{cfg.out_dir}/weather_forecast_csv")
        write_csv(forecast, f"{cfg.out_dir}/sales_forecast_csv")
    if cfg.forecast_table:
        write_guarded(forecast, cfg.forecast_table, FORECAST_TABLE_SCHEMA)
    return {"forecast": forecast, "metrics": metrics, "summary": summary | {"trained_at": trained_at.isoformat()}, "model": model}


def _train(training: DataFrame, cfg: JobConfig) -> ml.Selection:
    flagged = ml.split_last_days(training, n=cfg.valid_days)
    train = flagged.where(~F.col("is_valid")).drop("is_valid")
    valid = flagged.where(F.col("is_valid")).drop("is_valid")
    models = [
        (n, m) for n, m in ml.candidates(forest_trees=cfg.forest_trees, boost_iters=cfg.boost_iters) if n in cfg.models
    ]
    return ml.select_best(train, valid, models, ml.feature_stages([c for c in ml.FEATURE_COLUMNS if c in training.columns]))


def run_demo(spark: SparkSession, demo_csv: str, out_dir: str | None = None, trees: int = 300, train_frac: float = 0.8) -> dict[str, object]:
    """Train the demo day model from a headered CSV; model and metrics are written under ``out_dir`` when given.

    The CSV needs the columns of :data:`ml.DEMO_SCHEMA`, in any order and among others; missing ones are named.
    """
    header = spark.read.option("header", True).csv(demo_csv)
    wanted = T.StructType.fromDDL(ml.DEMO_SCHEMA)
    require_columns(header, wanted.names, "Dataset")
    typed = coerce(header, wanted).select(*wanted.names)
    model, metrics = ml.train_demo(typed, trees=trees, train_frac=train_frac)
    if out_dir:
        ml.save_model(model, f"{out_dir}/model")
        write_metrics(metrics, f"{out_dir}/metrics")
    return {"model": model, "metrics": metrics, "summary": metrics.first().asDict()}


def main(argv: list[str] | None = None) -> None:
    """``python -m geodemand.plans.job '<json config>'``; with ``demo_csv`` in it, :func:`run_demo` on that file."""
    from ..session import get_spark

    given = json.loads((argv or sys.argv[1:])[0])
    spark = get_spark()
    if "demo_csv" in given:
        print(json.dumps({**run_demo(spark, **given)["summary"], "config": given}))
        return
    cfg = JobConfig(**given)
    out = run(spark, cfg)
    print(json.dumps({**out["summary"], "config": asdict(cfg)}))


if __name__ == "__main__":
    main()
