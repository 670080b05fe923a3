"""Customer geography repair.

Latest version per customer -> normalised city/state and five-digit ZIP ->
ZIP reference voted by *all* customer rows -> fill only missing attributes ->
keep target places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.logic import flag_sum
from ..functions.text import clean_postcode, norm_text, strip_decimal_suffix, title_place
from ..operators.keyed import fill_from_reference, latest_version, mode_reference
from ..operators.sizing import bounded_broadcast


def with_norm_geo(df: DataFrame, city: str = "city", state: str = "state", postcode: str = "postcode") -> DataFrame:
    """Add ``postcode_clean``, ``postcode_5``, ``city_norm`` (lower),
    ``state_norm`` (upper); the ZIP expression is computed once."""
    return df.withColumns(
        {
            "postcode_clean": strip_decimal_suffix(postcode),
            "postcode_5": clean_postcode(postcode),
            "city_norm": norm_text(city, "lower"),
            "state_norm": norm_text(state, "upper"),
        }
    )


def zip_reference(customers: DataFrame, **cols) -> DataFrame:
    """ZIP -> most frequent (city, state) over every customer row (not only
    the latest versions); ties alphabetical."""
    g = with_norm_geo(customers, **cols)
    return mode_reference(g, "postcode_5", ["city_norm", "state_norm"]).select(
        "postcode_5",
        F.col("city_norm").alias("ref_city_norm"),
        F.col("state_norm").alias("ref_state_norm"),
        "n",
    )


def resolve_all(customers: DataFrame, key: str = "customer_id") -> DataFrame:
    """Every customer's latest version with resolved city/state and repair flags
    (before the target filter)."""
    latest = with_norm_geo(latest_version(customers, key))
    ref = zip_reference(customers)
    return fill_from_reference(
        latest,
        ref,
        "postcode_5",
        {"city_norm": "ref_city_norm", "state_norm": "ref_state_norm"},
        resolved={"city_norm": "resolved_city_norm", "state_norm": "resolved_state_norm"},
        flags={"city_norm": "city_repaired_by_postcode", "state_norm": "state_repaired_by_postcode"},
    )


def _targets(targets: DataFrame) -> DataFrame:
    t = targets.select(
        F.col(targets.columns[0]).alias("_t_city"), F.col(targets.columns[1]).alias("_t_state")
    ).distinct()
    return bounded_broadcast(t)


def resolve_places(customers: DataFrame, targets: DataFrame, key: str = "customer_id") -> DataFrame:
    """Resolved customers of the target places, one row per customer.

    ``targets`` has two columns: lower-case city, upper-case state. Output
    city is title-cased, state upper-cased; the cleaned postcode replaces the
    raw one.
    """
    r = resolve_all(customers, key)
    t = _targets(targets)
    kept = r.join(
        t, (F.col("resolved_city_norm") == F.col("_t_city")) & (F.col("resolved_state_norm") == F.col("_t_state"))
    )
    passthrough = [
        c
        for c in customers.columns
        if c not in (key, "city", "state", "postcode")
    ]
    return kept.select(
        key,
        title_place("resolved_city_norm").alias("city"),
        F.col("resolved_state_norm").alias("state"),
        F.col("postcode_clean").alias("postcode"),
        "postcode_5",
        *passthrough,
        "city_repaired_by_postcode",
        "state_repaired_by_postcode",
    )


def repair_funnel(customers: DataFrame, targets: DataFrame, key: str = "customer_id") -> DataFrame:
    """One row: scanned, missing city or state, missing without ZIP, repaired,
    still missing, retained in target places, retained and repaired.

    One pass over the resolved frame, with the target match as a flag from a
    left join, instead of re-running the resolution per figure.
    """
    r = resolve_all(customers, key)
    t = _targets(targets).withColumn("_is_target", F.lit(True))
    j = r.join(
        t,
        (F.col("resolved_city_norm") == F.col("_t_city")) & (F.col("resolved_state_norm") == F.col("_t_state")),
        "left",
    )
    missing = F.col("city_norm").isNull() | F.col("state_norm").isNull()
    repaired = F.col("city_repaired_by_postcode") | F.col("state_repaired_by_postcode")
    target = F.col("_is_target").isNotNull()
    return j.agg(
        F.count(F.lit(1)).alias("customers_scanned"),
        flag_sum(missing).alias("customers_missing_city_or_state"),
        flag_sum(missing & F.col("postcode_5").isNull()).alias("missing_city_or_state_without_zip5"),
        flag_sum(repaired).alias("customers_repaired_by_postcode"),
        flag_sum(F.col("resolved_city_norm").isNull() | F.col("resolved_state_norm").isNull()).alias(
            "customers_still_missing_after_repair"
        ),
        F.count_if(target).alias("customers_retained_target_cities"),
        flag_sum(target & repaired).alias("retained_customers_repaired"),
    )
