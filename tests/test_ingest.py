"""Payload parsing in both reference dialects, station search, collection summary."""

import json

from delaystar.operators import ingest

DEP = 1778940300  # 2026-05-16 14:05:00 UTC


def _departures(stops_form: str):
    stop_refs = [{"id": "STOP_1", "name": "North Gate", "lat": 47.25, "lon": "19.75"}]
    route_refs = [{"id": "LINE_3040", "shortName": "4", "type": "TRAM"}]
    trip_refs = [{"id": "TRIP_1", "routeId": "LINE_3040", "tripHeadsign": "South Gate", "directionId": "1"}]

    def refs(items):
        return items if stops_form == "array" else {x["id"]: x for x in items}

    return {
        "status": "OK",
        "data": {
            "entry": {"stopTimes": [
                {"stopId": "STOP_1", "tripId": "TRIP_1"},  # no departure time: dropped
                {"stopId": "STOP_1", "departureTime": DEP, "predictedDepartureTime": DEP + 120,
                 "tripId": "TRIP_1", "stopSequence": "7"},
                {"departureTime": str(DEP + 60), "tripId": "TRIP_2", "stopHeadsign": "Direct"},
                "not an object",
                {"stopId": "STOP_1", "departureTime": DEP + 600, "tripId": "TRIP_1"},
            ]},
            "references": {"stops": refs(stop_refs), "routes": refs(route_refs), "trips": refs(trip_refs)},
        },
    }


def _scan(spark, bodies):
    rows = [(f"p{i}", "RUN", "T", "STOP_1", None, b) for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "payload_id string, collection_run_id string, trip_id string, stop_id string, "
                                     "fetched_at timestamp_ntz, body string")
    return ingest.scan_payloads(df)


def test_parse_departures_both_dialects(spark):
    for form in ("array", "object"):
        scanned = _scan(spark, [json.dumps(_departures(form))])
        parsed = ingest.parse_departures(scanned, limit=2)
        obs = ingest.parsed_observations(parsed).orderBy("position").collect()
        assert len(obs) == 2, form
        first, second = obs
        assert first.delay_seconds == 120 and first.delay_category == "minor_delay"
        assert first.route_id == "LINE_3040" and first.headsign == "South Gate" and first.direction_id == "1"
        assert first.stop_sequence == 7
        assert first.duplicate_key == "TRIP_1|STOP_1|2026-05-16T14:05:00+00:00"
        # unknown trip: route falls back to '-' and the stop to the requested stop
        assert second.route_id == "-" and second.stop_id == "STOP_1" and second.headsign == "Direct"
        assert second.delay_seconds == 0 and second.stop_sequence == 0
        stops = ingest.parsed_stops(parsed).collect()
        assert [(s.id, s.name, s.lat, s.lon) for s in stops] == [("STOP_1", "North Gate", 47.25, 19.75)]
        routes = sorted((r.id, r.short_name, r.route_type) for r in ingest.parsed_routes(parsed).collect())
        assert routes == [("-", "-", ""), ("LINE_3040", "4", "TRAM")]


def test_bad_json_and_error_status_become_error_rows(spark):
    scanned = _scan(spark, ["{not json", json.dumps({"status": "ERROR", "text": "down"})]).collect()
    assert [r.accepted for r in scanned] == [False, False]
    assert scanned[0].error_message == "invalid JSON"
    assert scanned[1].error_message == "status ERROR: down"


def _search(form):
    stops = [
        {"id": "S1", "name": " East Square ", "code": "F1", "routeIds": ["R4", "R6", "", "R9"]},
        {"id": "S2", "name": "", "routeIds": ["R4"]},
        {"id": "S3", "name": "West Park", "routeIds": "R4"},
    ]
    routes = [{"id": "R4", "shortName": "4"}, {"id": "R6", "shortName": " 6 "}, {"id": "R9", "shortName": ""}]
    refs = (lambda xs: xs) if form == "array" else (lambda xs: {x["id"]: x for x in xs})
    return json.dumps({"status": "OK", "data": {"entry": {"stopIds": ["S1", "S2", "S1", "S3", "S4"]},
                                                "references": {"stops": refs(stops), "routes": refs(routes)}}})


def test_station_search_both_dialects(spark):
    for form in ("array", "object"):
        df = spark.createDataFrame([("q1", "East", _search(form)), ("q2", "Eas", _search(form))],
                                   "payload_id string, query string, body string")
        got = ingest.search_stations(df, limit=11).orderBy("position").collect()
        assert [(r.payload_id, r.stop_id, r.name, r.route_number) for r in got] == [
            ("q1", "S1", "East Square", "4, 6"), ("q1", "S3", "West Park", "")], form


def test_station_search_falls_back_to_reference_order(spark):
    body = json.dumps({"status": "OK", "data": {"entry": {}, "references": {
        "stops": {"Z9": {"name": "Last"}, "A1": {"name": "First"}}, "routes": {}}}})
    df = spark.createDataFrame([("q", "query", body)], "payload_id string, query string, body string")
    got = [r.stop_id for r in ingest.search_stations(df, limit=11).orderBy("position").collect()]
    assert got == ["Z9", "A1"]  # document order, not sorted


def test_collection_summary_partial_success(spark):
    good = json.dumps(_departures("array"))
    rows = [("a", "C1", "T", "STOP_1", None, good), ("b", "C1", "T", "STOP_2", None, "oops")]
    df = spark.createDataFrame(rows, "payload_id string, collection_run_id string, trip_id string, stop_id string, "
                                     "fetched_at timestamp_ntz, body string")
    scanned = ingest.scan_payloads(df)
    parsed = ingest.parse_departures(scanned, limit=4)
    obs = ingest.parsed_observations(parsed)
    target = obs.limit(0).select("duplicate_key")
    accepted = ingest.collect_accepted(target, obs)
    s = ingest.collection_summary(scanned, obs, accepted).first()
    assert (s.api_calls_succeeded, s.api_calls_failed, s.status) == (1, 1, "partial_success")
    assert s.observations_generated == 3 and s.observations_saved == 3
    errors = ingest.collection_errors(scanned).collect()
    assert [(e.stop_id, e.message) for e in errors] == [("STOP_2", "invalid JSON")]


def test_search_has_a_status_gate_and_drops_falsy_items(spark):
    stops = [{"id": "S1", "name": "\u00a0Hill\u2003\n", "routeIds": [0, "R4", False, "", None, "0"]}]
    routes = [{"id": "R4", "shortName": "4"}, {"id": "0", "shortName": "zero"}]
    data = {"entry": {"stopIds": [0, False, "S1"]}, "references": {"stops": stops, "routes": routes}}
    rows = [("ok", "Hill", json.dumps({"status": "OK", "data": data})), ("bad", "Hill", json.dumps({"status": "ERROR", "data": data}))]
    df = spark.createDataFrame(rows, "payload_id string, query string, body string")
    got = ingest.search_stations(df).collect()
    assert [(r.payload_id, r.stop_id, r.name, r.route_ids_text, r.route_number) for r in got] == [
        ("ok", "S1", "Hill", "R4,0", "4, zero")]
    errors = [r for r in ingest.scan_payloads(df).collect() if not r.accepted]
    assert [(r.payload_id, r.error_message) for r in errors] == [("bad", "status ERROR: ")]


def test_a_repeated_object_key_keeps_its_last_value(spark):
    body = json.dumps(_departures("object")).replace('"LINE_3040": {', '"LINE_3040": {"id": "x", "type": "OLD"}, "LINE_3040": {', 1)
    scanned = _scan(spark, [body])
    assert scanned.first().accepted
    routes = {r.id: r.route_type for r in ingest.parsed_routes(ingest.parse_departures(scanned, limit=2)).collect()}
    assert routes["LINE_3040"] == "TRAM"


def test_the_body_is_parsed_once_per_row(spark):
    scanned = _scan(spark, [json.dumps(_departures("array"))])
    obs = ingest.parsed_observations(ingest.parse_departures(scanned, limit=2))
    plan = obs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_parse_json(") + plan.count("parse_json(") - plan.count("try_parse_json(") <= 1


def test_a_parse_holds_typed_fields_of_odd_items(spark):
    """Items that are no objects, blank and repeated ids and fields of other types are read leniently; no VARIANT leaves the parse."""
    from pyspark.sql import functions as F

    body = {"status": "OK", "data": {
        "entry": {"stopTimes": [
            None, 7, [1], {"departureTime": "soon"}, {"departureTime": None},
            {"departureTime": DEP, "tripId": "", "stopId": "", "predictedDepartureTime": {"at": 1}, "stopSequence": "x"},
            {"departureTime": f"{DEP + 60}", "tripId": "T", "stopId": 9, "routeShortName": "44"},
            {"departureTime": DEP + 120, "tripId": "T", "routeId": "R", "stopId": "STOP_1"}]},
        "references": {
            "stops": [{"id": 9, "name": "old"}, 3, {"id": "", "name": "blank"}, {"id": "9", "name": "Nine", "lat": "1.5", "lon": [2]}],
            "trips": {"T": {"routeId": "", "tripHeadsign": "", "headsign": "H", "directionId": 1}, "": {"routeId": "of blank"}},
            "routes": {"R": "no object", "of blank": {"shortName": 5, "type": ""}}}}}
    parsed = ingest.parse_departures(_scan(spark, [json.dumps(body)]), limit=4)
    assert "variant" not in str(parsed.dtypes)
    obs = ingest.parsed_observations(parsed).orderBy("position")
    assert [tuple(r) for r in obs.select("position", "trip_id", "stop_id", "route_id", "headsign", "direction_id", "stop_sequence", "delay_seconds").collect()] == [
        (0, "", "STOP_1", "of blank", "-", "", 0, 0), (1, "T", "9", "44", "H", "1", 0, 0), (2, "T", "STOP_1", "R", "H", "1", 0, 0)]
    routes = ingest.parsed_routes(parsed).orderBy("position").select("position", "id", "short_name", "route_type")
    assert [tuple(r) for r in routes.collect()] == [(0, "of blank", "5", ""), (1, "44", "44", ""), (2, "R", "R", "")]
    stops = ingest.parsed_stops(parsed).orderBy("position").select("position", "id", "name", "lat", "lon")
    assert [tuple(r) for r in stops.collect()] == [(0, "STOP_1", "STOP_1", None, None), (1, "9", "Nine", 1.5, None)]
    none = ingest.parsed_stops(parsed.withColumn("_stops", F.transform("_stops", lambda x: x.withField("id", F.lit(None).cast("string")))))
    assert none.isEmpty()


def test_stops_after_one_without_an_id_are_not_entities(spark):
    body = json.dumps({"status": "OK", "data": {"entry": {"stopTimes": [
        {"departureTime": DEP, "stopId": "A"}, {"departureTime": DEP, "stopId": "A"}, {"departureTime": DEP}, {"departureTime": DEP, "stopId": "B"}]}}})
    df = spark.createDataFrame([("p", "RUN", "T", None, None, body)], "payload_id string, collection_run_id string, trip_id string, "
                               "stop_id string, fetched_at timestamp_ntz, body string")
    stops = ingest.parsed_stops(ingest.parse_departures(ingest.scan_payloads(df), limit=4))
    assert [(s.position, s.id) for s in stops.collect()] == [(0, "A")]


def test_the_entities_of_a_parse_are_written_once(spark, monkeypatch):
    """The operational store reads what one parse wrote of routes and stops, not the whole parse."""
    from delaystar.plans import registry

    from .conftest import SMALL_SF

    written = []
    keep = registry.dimension
    monkeypatch.setattr(registry, "dimension", lambda df: written.append(df.columns) or keep(df))
    j = registry.Job(spark, SMALL_SF)
    root = registry._operational_store(j)
    assert written == [["payload_id", "fetched_at", "_route_entities", "_stop_entities"]]
    for name, target, rows in (("routes", j.routes, ingest.parsed_routes), ("stops", j.stops, ingest.parsed_stops)):
        want = ingest.upsert_entities(target, rows(registry._parsed(j)))
        assert sorted(map(repr, spark.read.parquet(f"{root}/{name}").collect())) == sorted(map(repr, want.collect()))


def test_requested_stops_drive_the_collection_report(spark):
    good = json.dumps(_departures("array"))
    df = spark.createDataFrame([("a", "C1", "T", "STOP_1", None, good)], "payload_id string, collection_run_id string, "
                               "trip_id string, stop_id string, fetched_at timestamp_ntz, body string")
    requested = spark.createDataFrame([("C1", "STOP_1", "North Gate"), ("C1", "STOP_2", "South Gate"), ("C1", "", "Blank")],
                                      "collection_run_id string, stop_id string, stop_name string")
    scanned = ingest.scan_payloads(df)
    obs = ingest.parsed_observations(ingest.parse_departures(scanned, limit=4))
    s = ingest.collection_summary(scanned, obs, obs, requested=requested).first()
    assert (s.stops_requested, s.api_calls_succeeded, s.api_calls_failed, s.status) == (3, 1, 1, "partial_success")
    errors = ingest.collection_errors(scanned, requested).collect()
    assert [(e.stop_id, e.stop_name, e.message) for e in errors] == [("STOP_2", "South Gate", "no payload")]


def _large(n, form):
    """A payload with ``n`` references of each kind; in the array form every id comes twice, the later one counts."""
    stops = [{"id": f"S{i}", "name": f"Stop {i}", "code": "c", "routeIds": [f"R{i}", f"R{i + 1}"]} for i in range(n)]
    routes = [{"id": f"R{i}", "shortName": str(i), "type": "BUS"} for i in range(n)]
    trips = [{"id": f"T{i}", "routeId": f"R{i}", "tripHeadsign": f"H{i}"} for i in range(n)]
    old = [{"id": x["id"], "name": "old", "shortName": "old", "routeId": "old"} for x in stops]
    refs = (lambda xs: old + xs) if form == "array" else (lambda xs: {x["id"]: x for x in xs})
    stop_times = [{"stopId": f"S{i}", "departureTime": DEP + i, "tripId": f"T{i}"} for i in range(n - 3, n)]
    return json.dumps({"status": "OK", "data": {"entry": {"stopTimes": stop_times},
                                                "references": {"stops": refs(stops), "routes": refs(routes), "trips": refs(trips)}}})


def test_payloads_with_100000_references_parse_in_linear_time(spark):
    """Both dialects; ten times the references may take some ten times as long, not a hundred."""
    import time

    for form, sizes in (("array", (1_700, 17_000)), ("object", (3_400, 34_000))):  # six and three references each
        took = []
        for n in sizes:
            body = _large(n, form)
            started = time.time()
            got = ingest.parsed_observations(ingest.parse_departures(_scan(spark, [body]), limit=2)).orderBy("position").collect()
            assert [(r.route_id, r.stop_id, r.headsign) for r in got] == [(f"R{n - 3}", f"S{n - 3}", f"H{n - 3}"), (f"R{n - 2}", f"S{n - 2}", f"H{n - 2}")]
            df = spark.createDataFrame([("q", "Stop", body)], "payload_id string, query string, body string")
            stations = ingest.search_stations(df, limit=3).orderBy("position").collect()
            assert [(r.stop_id, r.name, r.route_number) for r in stations] == [(f"S{i}", f"Stop {i}", f"{i}, {i + 1}") for i in range(3)]
            took.append(time.time() - started)
        assert took[1] < 30 * max(took[0], 0.5), took


def test_the_monitored_stops_drive_the_report(spark):
    """Every monitored stop is a call of each collection; one has landed, the others have no payload."""
    from delaystar.sources import extract

    stops = extract.monitored_stops(spark)
    first = stops.first()
    good = json.dumps(_departures("array"))
    df = spark.createDataFrame([("a", "C1", "T", first.stop_id, None, good), ("b", "C2", "T", "elsewhere", None, good)],
                               "payload_id string, collection_run_id string, trip_id string, stop_id string, fetched_at timestamp_ntz, body string")
    scanned = ingest.scan_payloads(df)
    obs = ingest.parsed_observations(ingest.parse_departures(scanned, limit=4))
    requested = ingest.requested_stops(scanned, stops)
    got = {r.collection_run_id: (r.stops_requested, r.api_calls_succeeded, r.api_calls_failed, r.status)
           for r in ingest.collection_summary(scanned, obs, obs, requested=requested).collect()}
    n = stops.count()
    assert got == {"C1": (n, 1, n - 1, "partial_success"), "C2": (n, 0, n, "failed")}
    errors = ingest.collection_errors(scanned, requested)
    assert errors.where("message = 'no payload'").count() == 2 * n - 1
