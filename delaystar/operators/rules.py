"""Every scalar rule applied to the observation store (one row per observation).

This is the set-level form of F1..F29: each column is one rule, evaluated by
whole-stage codegen in a single projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaystar import settings as S
from delaystar.functions import columns as C
from delaystar.functions import identity


def scalar_rules(observations: DataFrame, zone: str = S.LOCAL_ZONE) -> DataFrame:
    local = C.local_time("created_at", zone)
    minutes = C.delay_minutes("delay_seconds")
    epoch = C.epoch_seconds("scheduled_departure")
    return observations.select(
        "observation_id",
        C.date_key("created_at", zone).alias("date_key"),                                   # F1
        minutes.alias("delay_minutes"),                                                      # F2
        C.warehouse_category("delay_seconds").alias("warehouse_category"),                   # F3
        C.operational_category("delay_seconds").alias("operational_category"),               # F4
        C.time_period(F.hour(local)).alias("time_period"),                                   # F5
        C.delay_seconds_between("scheduled_departure", "predicted_departure").alias("recomputed_delay"),  # F6/F7
        C.display_category("delay_category", "delay_seconds").alias("display_category"),     # F8
        C.route_number_from_id("route_id").alias("route_number"),                            # F9
        C.normalized_headsign("headsign").alias("normalized_headsign"),                      # F10
        C.clean_headsign("headsign").alias("clean_headsign"),                                # F11
        identity.duplicate_key(F.col("trip_id"), F.col("stop_id"), F.col("scheduled_departure"))
        .alias("natural_key"),                                                               # F12
        identity.uuid5(F.col("duplicate_key")).alias("stable_id"),                          # F13
        local.alias("local_observed_at"),                                                    # F14
        F.hour(local).alias("local_hour"),
        C.day_of_week_sunday_first(F.to_date(local)).alias("local_day_of_week"),             # F15
        C.local_clock("scheduled_departure", zone).alias("scheduled_clock"),                 # F19/F20
        epoch.alias("scheduled_epoch"),                                                      # F22
        C.epoch_to_time(epoch).alias("scheduled_from_epoch"),
        C.safe_date(F.col("created_at")).alias("created_date"),                              # F27
        C.kpi_target_flag(minutes).alias("target_flag"),                                     # F28
    )
