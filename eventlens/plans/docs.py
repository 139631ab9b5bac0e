"""Column descriptions persisted with the tables (S16) and view registration.

Descriptions travel as Spark column metadata (``comment``), which Spark keeps
in the Parquet footer and shows in ``DESCRIBE`` for catalog tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DESCRIPTIONS: dict[str, dict[str, str]] = {
    "event": {
        "unique_event_id": "Hash of insert id, person, event type, day and connection; one row per value.",
        "loaded_at": "When the loader delivered the row.",
        "loader_row_id": "The loader's own id of the raw row.",
        "app_session_length": "Length of the app session, as the client measured it.",
        "app_build_number": "Build number of the app.",
        "app_version": "Version of the app.",
        "has_bluetooth_enabled": "Whether Bluetooth was on.",
        "bluetooth_version": "Bluetooth version of the device.",
        "device_brand": "Brand of the device.",
        "browser": "Name of the browser.",
        "browser_version": "Major version of the browser.",
        "wireless_carrier": "Mobile network operator of the device.",
        "city": "City, located by the client's address.",
        "current_url": "Address of the page on which the event happened.",
        "device_name": "Name of the device.",
        "device_id": "Id of the device or browser; kept while the person is unknown.",
        "people_id": "Id of the person, as known when the event arrived.",
        "people_id_before_identified": "Id of the person before it was tied to a known one.",
        "google_play_service_status": "State of the Play services on the device.",
        "has_near_field_communication": "Whether the device has a near-field chip.",
        "has_telephone": "Whether the device can make calls.",
        "initial_referrer": "Address from which the person came the first time.",
        "initial_referring_domain": "Domain of that address.",
        "insert_id": "Client-made id of the event; equal on repeated deliveries.",
        "library_version": "Version of the tracking library.",
        "device_manufacturer": "Maker of the device.",
        "device_model": "Model of the device.",
        "country_code": "Two-letter country, located by the client's address.",
        "referrer_keywords": "Search words of the referring page.",
        "library": "Tracking library that sent the event.",
        "mp_processing_time_ms": "When the event was processed, in milliseconds since 1970; the smallest of a duplicate group wins.",
        "event_type_original_casing": "Event name as sent.",
        "os": "Operating system.",
        "os_version": "Version of the operating system.",
        "event_properties": "All other properties of the event, as JSON text.",
        "network_type": "Kind of mobile network.",
        "referrer": "Address of the page before.",
        "referring_domain": "Domain of the page before.",
        "region": "Region or state, located by the client's address.",
        "screen_pixel_density": "Pixels per inch of the screen.",
        "screen_height": "Height of the screen in pixels.",
        "screen_width": "Width of the screen in pixels.",
        "search_engine": "Search engine that led to the page.",
        "occurred_at": "When the event happened.",
        "has_wifi_connected": "Whether the device was on a wireless network.",
        "source_relation": "Connection the row was read from.",
        "date_day": "Calendar day of the event time.",
        "event_type": "Event name in lower case.",
        "nth_event_record": "Rank of the row inside its duplicate group; always 1 after de-duplication.",
        "run_date": "As-of date of the run that wrote the row.",
    },
    "daily_events": {
        "source_relation": "Connection of the events.",
        "date_day": "Calendar day; idle days of a type have rows too.",
        "event_type": "Event name in lower case.",
        "run_date": "As-of date of the run that wrote the row.",
        "number_of_events": "De-duplicated events of the type on the day (known persons only).",
        "number_of_users": "Persons with at least one event of the type on the day.",
        "number_of_new_users": "Persons whose all-time first event of the type is on this day.",
        "number_of_repeat_users": "Persons active on the day and on one of the 27 days before.",
        "number_of_return_users": "Active persons that are neither new nor repeat.",
        "trailing_users_28d": "Persons with an event of the type in the 28 days ending on the day.",
        "trailing_users_7d": "Persons with an event of the type in the 7 days ending on the day.",
        "unique_key": "Event type, day and connection joined by '-'.",
    },
    "monthly_events": {
        "source_relation": "Connection of the events.",
        "date_month": "First day of the month.",
        "event_type": "Event name in lower case.",
        "run_date": "As-of date of the run that wrote the row.",
        "total_monthly_active_users": "Distinct persons with any event in the month and connection.",
        "number_of_users": "Persons with an event of the type in the month.",
        "number_of_new_users": "Persons whose first month for the type is this month.",
        "number_of_repeat_users": "Persons also active for the type in the previous month.",
        "number_of_return_users": "Persons whose previous active month for the type is two or more months back.",
        "number_of_events": "Events of the type in the month, persons unknown included.",
        "number_of_churn_users": "Users of the previous active row minus this month's repeat users.",
        "unique_key": "Month, event type and connection joined by '-'.",
    },
    "sessions": {
        "source_relation": "Connection of the events.",
        "people_id": "Person of the session's first event.",
        "device_id": "Device of the session's first event.",
        "session_number": "Number of the session within the actor's day, from 1.",
        "run_date": "As-of date of the run that wrote the row.",
        "session_id": "Hash of actor, session number, day and connection.",
        "user_id": "Actor: device id when present, else person id.",
        "session_started_at": "Time of the first event of the session.",
        "session_started_on_day": "Day of the session; sessions never cross midnight.",
        "total_number_of_events": "Events in the session.",
        "event_frequencies": "Events per type in the session, as '{type: n, ...}' sorted by type.",
    },
}


def with_descriptions(df: DataFrame, table: str) -> DataFrame:
    """Attach the descriptions of ``table`` as column metadata (a projection, no job)."""
    docs = DESCRIPTIONS.get(table, {})
    return df.select(*[F.col(f"`{c}`").alias(c, metadata={"comment": docs[c]}) if c in docs else F.col(f"`{c}`")
                       for c in df.columns])


def register_views(spark: SparkSession, models: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Expose lazy models as temporary views for SQL users."""
    names = []
    for name, df in models.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    return names
