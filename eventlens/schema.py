"""Column catalogue of the conformed event table.

FIXED VALUES: the raw source column names, their target types and their
output aliases below are the contract of the event table; a loader that
names its raw columns differently is mapped with ``Config.raw_names``.  They are listed plainly in the order
of the upstream catalogue (raw name, type, output alias or None).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: raw event columns (name, type, alias) -------------------
EVENT_COLUMNS: tuple[tuple[str, T.DataType, str | None], ...] = (
    ("loaded_at", T.TimestampType(), None),
    ("loader_row_id", T.StringType(), None),
    ("ae_session_length", T.StringType(), "app_session_length"),
    ("app_build_number", T.StringType(), None),
    ("app_version_string", T.StringType(), "app_version"),
    ("bluetooth_enabled", T.BooleanType(), "has_bluetooth_enabled"),
    ("bluetooth_version", T.StringType(), None),
    ("brand", T.StringType(), "device_brand"),
    ("browser", T.StringType(), None),
    ("browser_version", T.IntegerType(), None),
    ("carrier", T.StringType(), "wireless_carrier"),
    ("city", T.StringType(), None),
    ("current_url", T.StringType(), None),
    ("device", T.StringType(), "device_name"),
    ("device_id", T.StringType(), None),
    ("distinct_id", T.StringType(), "people_id"),
    ("distinct_id_before_identity", T.StringType(), "people_id_before_identified"),
    ("google_play_services", T.StringType(), "google_play_service_status"),
    ("has_nfc", T.BooleanType(), "has_near_field_communication"),
    ("has_telephone", T.BooleanType(), None),
    ("initial_referrer", T.StringType(), None),
    ("initial_referring_domain", T.StringType(), None),
    ("insert_id", T.StringType(), None),
    ("lib_version", T.StringType(), "library_version"),
    ("manufacturer", T.StringType(), "device_manufacturer"),
    ("model", T.StringType(), "device_model"),
    ("mp_country_code", T.StringType(), "country_code"),
    ("mp_keyword", T.StringType(), "referrer_keywords"),
    ("mp_lib", T.StringType(), "library"),
    ("mp_processing_time_ms", T.LongType(), None),
    ("name", T.StringType(), "event_type_original_casing"),
    ("os", T.StringType(), None),
    ("os_version", T.StringType(), None),
    ("properties", T.StringType(), "event_properties"),
    ("radio", T.StringType(), "network_type"),
    ("referrer", T.StringType(), None),
    ("referring_domain", T.StringType(), None),
    ("region", T.StringType(), None),
    ("screen_dpi", T.IntegerType(), "screen_pixel_density"),
    ("screen_height", T.IntegerType(), None),
    ("screen_width", T.IntegerType(), None),
    ("search_engine", T.StringType(), None),
    ("time", T.TimestampNTZType(), "occurred_at"),
    ("wifi", T.BooleanType(), "has_wifi_connected"),
)
# --- end of fixed values ----------------------------------------------------

# Placeholder used for NULL parts of a surrogate key (fixed value).
SURROGATE_NULL = "_surrogate_key_null_"


def conformed_names() -> list[str]:
    """Output names of the 44 conformed columns, in catalogue order."""
    return [alias or name for name, _, alias in EVENT_COLUMNS]


def conformed_schema() -> T.StructType:
    return T.StructType([T.StructField(alias or name, dtype, True) for name, dtype, alias in EVENT_COLUMNS])


def raw_schema(extra: dict[str, T.DataType] | None = None) -> T.StructType:
    """Schema of a raw event table holding every catalogued column."""
    fields = [T.StructField(name, dtype, True) for name, dtype, _ in EVENT_COLUMNS]
    for name, dtype in (extra or {}).items():
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)
