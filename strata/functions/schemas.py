"""Declared schemas and JSON text options shared by sources and sinks."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the brewery record, in the order the API
# documents them (every field optional; `id` carries the URL in a sentinel row).
BREWERY_FIELDS = [
    "id", "name", "brewery_type", "address_1", "address_2", "address_3", "city",
    "state_province", "postal_code", "country", "longitude", "latitude", "phone",
    "website_url", "state", "street",
]

# Coordinates arrive as numbers or numeric strings; bronze keeps them as text and
# silver converts them with try_cast, so a dirty value becomes null there.
BREWERY_CASTS = {"longitude": "DOUBLE", "latitude": "DOUBLE"}

BREWERY_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType(), True) for f in BREWERY_FIELDS]
)

# JSON text options that make a bronze round trip lossless: microsecond
# timestamps both for zoned and zone-less types (the default cuts to millis).
JSON_TS_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "dateFormat": "yyyy-MM-dd",
}
