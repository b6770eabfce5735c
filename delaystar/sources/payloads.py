"""Landed API payloads derived from the test observations (S1 input).

One departures payload per collected trip (``collection_run_id``, ``trip_id``):
its stop times in stop-sequence order and the references they need.  A payload
holds one trip's stop times, like a real stop-departures response that the
request limit keeps small, so the per-payload ``collect_list`` stays bounded
(a fixed set of payloads per stop would grow with the data instead).

Rules that make the payloads exercise every parser path:
- reference dialect: array of objects when the requested stop number is even,
  object keyed by id when it is odd;
- ``departureTime`` omitted when ``part % 97 == 1`` (row dropped by P9);
- ``predictedDepartureTime`` omitted when ``part % 89 == 2`` (falls back, delay 0);
- ``stopHeadsign`` only when ``part`` is even (else the trip headsign is used);
- ``routeId`` on the stop time only for the unknown route (else through the trip);
- body cut short (bad JSON) when ``order % 101 == 7``; status ``ERROR`` when
  ``order % 103 == 5``.
A station-search payload per trip lists the trip's stops (C2); ``stopIds`` is
left out when ``order % 7 == 3`` so the parser falls back to the references.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaystar.functions import columns as C
from delaystar.session import dimension
from delaystar.sources.testdata import ROUTE_BY_ORDER_MOD5, TIE_COLUMNS

def order_number(trip_id: str = "trip_id") -> Column:
    return F.substring(F.col(trip_id), 3, 64).cast("bigint")


def trip_route(order: Column) -> Column:
    expr = None
    for i, rid in enumerate(ROUTE_BY_ORDER_MOD5):
        expr = F.when(order % 5 == i, rid) if expr is None else expr.when(order % 5 == i, rid)
    return expr


def trip_direction(order: Column) -> Column:
    return F.when(order % 50 == 0, F.lit("")).otherwise((order % 2).cast("string"))


def _refs_json(refs: Column, object_form: Column) -> Column:
    """JSON of a reference list: array of objects, or object keyed by id."""
    as_map = F.map_from_entries(F.transform(refs, lambda r: F.struct(r["id"].alias("k"), r.alias("v"))))
    return F.when(object_form, F.to_json(as_map)).otherwise(F.to_json(refs))


#: What a payload takes from an observation; only these columns are shuffled.
ITEM_COLUMNS = ("collection_run_id", "trip_id", "stop_id", "route_id", "headsign", "stop_sequence", "scheduled_departure",
                "predicted_departure", "created_at", *TIE_COLUMNS)


def _items(raw: DataFrame, routes: DataFrame, stops: DataFrame, *columns: str) -> DataFrame:
    """Observation rows dealt by trip, then given their reference objects.

    The references are first cut to the stops and routes that occur and written, so the planner
    knows how few they are: a few hot stops are then not joined by a shuffle against the whole
    stop table, and the trips are shuffled before their rows grow by the references.
    """
    seen = dimension(raw.select("stop_id", "route_id", trip_route(order_number()).alias("trip_route_id")).distinct())
    seen_routes = seen.select("route_id").union(seen.select("trip_route_id"))
    stops = dimension(stops.join(seen.select(F.col("stop_id").alias("id")), "id", "left_semi"))
    routes = dimension(routes.join(seen_routes.select(F.col("route_id").alias("id")), "id", "left_semi"))
    stop_ref = stops.select(
        F.col("id").alias("stop_id"),
        F.struct(F.col("id"), F.col("name"), F.col("lat"), F.col("lon"),
                 F.col("id").alias("code")).alias("stop_ref"),
    )
    route_ref = routes.select(
        F.col("id").alias("route_id"),
        F.struct(F.col("id"), F.col("short_name").alias("shortName"), F.col("route_type").alias("type"))
        .alias("route_ref"),
    )
    trip_route_ref = route_ref.select(F.col("route_id").alias("trip_route_id"),
                                      F.col("route_ref").alias("trip_route_ref"))
    return (
        raw.select(*columns).repartition("collection_run_id", "trip_id")
        .withColumn("trip_route_id", trip_route(order_number()))
        .join(stop_ref, "stop_id", "left")
        .join(route_ref, "route_id", "left")
        .join(trip_route_ref, "trip_route_id", "left")
    )


def departure_payloads(raw: DataFrame, routes: DataFrame, stops: DataFrame) -> DataFrame:
    """(payload_id, collection_run_id, trip_id, stop_id, fetched_at, body) per collected trip."""
    order = order_number()
    part = F.col("tie_1")
    stop_time = F.struct(
        F.col("stop_id").alias("stopId"),
        F.when(part % 97 == 1, F.lit(None)).otherwise(C.epoch_seconds(F.col("scheduled_departure")))
        .alias("departureTime"),
        F.when(part % 89 == 2, F.lit(None)).otherwise(C.epoch_seconds(F.col("predicted_departure")))
        .alias("predictedDepartureTime"),
        F.when(F.col("route_ref").isNull(), F.col("route_id")).alias("routeId"),
        F.when(part % 2 == 0, F.col("headsign")).alias("stopHeadsign"),
        F.col("trip_id").alias("tripId"),
        F.col("stop_sequence").alias("stopSequence"),
    )
    item = F.struct(
        F.col("stop_sequence").alias("k1"), F.col("tie_1").alias("k2"), F.col("tie_2").alias("k3"),
        F.col("tie_3").alias("k4"), F.col("tie_4").alias("k5"),
        stop_time.alias("st"), F.col("stop_ref").alias("stop_ref"),
        F.col("route_ref").alias("route_ref"), F.col("trip_route_ref").alias("trip_route_ref"),
        F.col("headsign").alias("headsign"),
    )
    g = _items(raw, routes, stops, *ITEM_COLUMNS).groupBy("collection_run_id", "trip_id").agg(
        F.sort_array(F.collect_list(item)).alias("items"),
        F.max("created_at").alias("fetched_at"),
    )
    first = F.col("items")[0]
    requested = first["st"]["stopId"]
    object_form = F.substring(requested, 3, 8).cast("int") % 2 == 1
    items = F.col("items")
    stop_refs = F.array_compact(F.array_distinct(items["stop_ref"]))
    route_refs = F.array_compact(F.array_distinct(F.concat(items["route_ref"], items["trip_route_ref"])))
    trip_refs = F.transform(F.array_distinct(items["headsign"]), lambda h: F.struct(
        F.col("trip_id").alias("id"), trip_route(order).alias("routeId"), h.alias("tripHeadsign"),
        trip_direction(order).alias("directionId")))
    entry = F.struct(requested.alias("stopId"), items["st"].alias("stopTimes"))
    o = order_number()
    status = F.when(o % 103 == 5, F.lit("ERROR")).otherwise(F.lit("OK"))
    body = F.when(o % 101 == 7, F.expr("substring(body_full, 1, length(body_full) - 2)")).otherwise(F.col("body_full"))
    return g.select(
        F.concat_ws("/", "collection_run_id", "trip_id").alias("payload_id"),
        "collection_run_id", "trip_id", requested.alias("stop_id"), "fetched_at",
        F.concat(
            F.lit('{"status":"'), status, F.lit('",'),
            F.when(o % 103 == 5, F.lit('"text":"upstream unavailable",')).otherwise(F.lit("")),
            F.lit('"data":{"entry":'), F.to_json(entry),
            F.lit(',"references":{"stops":'), _refs_json(stop_refs, object_form),
            F.lit(',"routes":'), _refs_json(route_refs, object_form),
            F.lit(',"trips":'), _refs_json(trip_refs, object_form),
            F.lit("}}}"),
        ).alias("body_full"),
    ).select("payload_id", "collection_run_id", "trip_id", "stop_id", "fetched_at", body.alias("body"))


def search_payloads(raw: DataFrame, routes: DataFrame, stops: DataFrame) -> DataFrame:
    """(payload_id, query, body) station-search responses, one per collected trip."""
    order = order_number()
    item = F.struct(
        F.col("stop_sequence").alias("k1"), F.col("tie_1").alias("k2"), F.col("tie_2").alias("k3"),
        F.col("tie_3").alias("k4"), F.col("tie_4").alias("k5"),
        F.col("stop_id").alias("stop_id"), F.col("stop_ref").alias("stop_ref"),
        F.col("trip_route_ref").alias("route_ref"), F.col("trip_route_id").alias("trip_route_id"),
    )
    g = _items(raw, routes, stops, "collection_run_id", "trip_id", "stop_id", "route_id", "stop_sequence",
               *TIE_COLUMNS).groupBy("collection_run_id", "trip_id").agg(
        F.sort_array(F.collect_list(item)).alias("items"))
    o = order_number()
    first_stop = F.col("items")[0]["stop_id"]
    object_form = o % 2 == 1
    stop_refs = F.array_distinct(F.filter(F.transform("items", lambda x: F.struct(
        x["stop_ref"]["id"].alias("id"), x["stop_ref"]["name"].alias("name"), x["stop_ref"]["code"].alias("code"),
        F.lit("").alias("direction"), x["stop_ref"]["lat"].alias("lat"), x["stop_ref"]["lon"].alias("lon"),
        F.array(x["trip_route_id"], F.lit("")).alias("routeIds"))), lambda r: r["id"].isNotNull()))
    route_refs = F.array_distinct(F.filter(F.transform("items", lambda x: x["route_ref"]), lambda r: r.isNotNull()))
    stop_ids = F.transform("items", lambda x: x["stop_id"])
    entry = F.when(o % 7 == 3, F.lit("{}")).otherwise(F.to_json(F.struct(stop_ids.alias("stopIds"))))
    body = F.concat(
        F.lit('{"status":"OK","data":{"entry":'), entry,
        F.lit(',"references":{"stops":'), _refs_json(stop_refs, object_form),
        F.lit(',"routes":'), _refs_json(route_refs, object_form), F.lit("}}}"),
    )
    query = F.when(o % 10 == 0, F.lit("Sto")).otherwise(F.concat(F.lit("Stop "), F.substring(first_stop, 3, 8)))
    return g.select(
        F.concat_ws("/", "collection_run_id", "trip_id").alias("payload_id"),
        query.alias("query"), body.alias("body"),
    )
