"""Deterministic trip key (``trip_id``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fields hashed into trip_id, in order, and the separator.
TRIP_KEY_FIELDS = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
)
TRIP_KEY_SEPARATOR = "|"


def trip_id(fields: tuple[str, ...] = TRIP_KEY_FIELDS) -> Column:
    """SHA-256 hex of the ``|``-joined string forms of the key fields.

    ``concat_ws`` skips NULL parts, so a NULL vendor simply vanishes from the
    key text.  Trip times are TIMESTAMP_NTZ, so their text form does not depend
    on the session time zone.
    """
    parts = [F.col(name).cast("string") for name in fields]
    return F.sha2(F.concat_ws(TRIP_KEY_SEPARATOR, *parts), 256)
