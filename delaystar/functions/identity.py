"""Natural keys and stable observation ids as column expressions.

``duplicate_key`` is ``trip|stop|scheduled`` with the scheduled instant written
in ISO form with a ``+00:00`` offset (timestamps are UTC).  ``observation_id``
is a name-based UUID (version 5, URL namespace) of that key, computed with the
built-in ``sha1`` so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from delaystar import settings as S


def micros_of_second(ts: Column) -> Column:
    """Microseconds within the second of an NTZ value (no session-zone conversion)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.pmod(F.timestamp_diff("MICROSECOND", epoch, ts), F.lit(1_000_000))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text of a UTC NTZ instant with an explicit +00:00 offset.

    Built from ``cast(ts as string)`` rather than ``date_format``: the latter
    goes through the session zone and shifts wall-clock times that fall into
    that zone's daylight-saving gap.
    """
    base = F.translate(F.substring(ts.cast("string"), 1, 19), " ", "T")
    micros = micros_of_second(ts)
    return F.concat(
        base,
        F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(F.lit("")),
        F.lit(S.UTC_OFFSET_TEXT),
    )


def duplicate_key(trip_id: Column, stop_id: Column, scheduled: Column) -> Column:
    """natural key of one departure at one stop."""
    return F.concat_ws(S.KEY_SEPARATOR, trip_id, stop_id, iso_utc(scheduled))


def name_digest(name: Column, namespace_hex: str = S.UUID_NAMESPACE_URL_HEX) -> Column:
    """SHA-1 hex of namespace bytes + UTF-8 name (the hash behind a v5 UUID)."""
    return F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(name, "UTF-8")))


def uuid5(name: Column, namespace_hex: str = S.UUID_NAMESPACE_URL_HEX) -> Column:
    """RFC 4122 version-5 UUID text of ``name`` (UTF-8) in ``namespace_hex``."""
    return uuid_from_digest(name_digest(name, namespace_hex))


def uuid_from_digest(h: Column) -> Column:
    """Format a SHA-1 hex digest as a version-5 UUID (version nibble 5, RFC variant)."""
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )


def observation_id(trip_id: Column, stop_id: Column, scheduled: Column) -> Column:
    """id that ignores the collection time (collected form)."""
    return uuid5(duplicate_key(trip_id, stop_id, scheduled))


def run_scoped_observation_id(
    run_id: Column, trip_id: Column, stop_id: Column, scheduled: Column, index: Column
) -> Column:
    """F13 variant used when no collection time is known: run and index join the key."""
    return uuid5(F.concat_ws(S.KEY_SEPARATOR, run_id, trip_id, stop_id, iso_utc(scheduled), index.cast("string")))
