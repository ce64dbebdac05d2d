"""Fixed schemas, domains and the operating-company code map.

Everything in the FIXED VALUES block must stay equal to the feed contract and
the warehouse contract the queries are written against; it is data, not
logic, and is kept together and in its natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (feed / warehouse contract)
# ---------------------------------------------------------------------------

# Message type of a train movement in the movement feed.
MOVEMENT_MSG_TYPE = "0003"

# Warehouse table columns, in load order (all STRING unless typed below).
WAREHOUSE_COLUMNS = [
    "event_type", "toc_id", "variation_status", "uk_datetime", "timestamp",
    "processed_at", "actual_timestamp", "gbtt_timestamp", "loc_stanox",
    "planned_timestamp", "timetable_variation", "train_id",
    "delay_monitoring_point", "next_report_run_time", "reporting_stanox",
    "correction_ind", "event_source", "train_file_address", "division_code",
    "train_terminated", "offroute_ind", "train_service_code", "auto_expected",
    "route", "planned_event_type", "next_report_stanox",
]

# Body fields the daily load lifts out of the raw message body.
FLATTENED_BODY_FIELDS = [
    "actual_timestamp", "gbtt_timestamp", "loc_stanox", "planned_timestamp",
    "timetable_variation", "train_id", "delay_monitoring_point",
    "next_report_run_time", "reporting_stanox", "correction_ind",
    "event_source", "train_file_address", "division_code", "train_terminated",
    "offroute_ind", "train_service_code", "auto_expected", "route",
    "planned_event_type", "next_report_stanox",
]

# Body fields the staging view reads that the warehouse load does not write.
STAGING_ONLY_FIELDS = [
    "original_loc_stanox", "original_loc_timestamp", "current_train_id",
    "platform", "direction_ind", "line_ind",
]

# Staging view columns, in view order.
STAGING_COLUMNS = [
    "event_type", "gbtt_timestamp", "original_loc_stanox", "planned_timestamp",
    "timetable_variation", "original_loc_timestamp", "current_train_id",
    "delay_monitoring_point", "next_report_run_time", "reporting_stanox",
    "actual_timestamp", "correction_ind", "event_source", "train_file_address",
    "platform", "division_code", "train_terminated", "train_id", "offroute_ind",
    "variation_status", "train_service_code", "toc_id", "loc_stanox",
    "auto_expected", "direction_ind", "route", "planned_event_type",
    "next_report_stanox", "line_ind",
]

# Key columns a loaded row must have (all non-null).
KEY_COLUMNS = ["train_id", "actual_timestamp", "toc_id"]
# Fields whose null counts the load reports.
CRITICAL_FIELDS = ["actual_timestamp", "train_id", "event_type"]

# Accepted values.
EVENT_TYPES = ["ARRIVAL", "DEPARTURE"]
VARIATION_STATUSES = ["ON TIME", "EARLY", "LATE", "OFF ROUTE"]
PLANNED_EVENT_TYPES = ["ARRIVAL", "DEPARTURE", "DESTINATION"]
EVENT_SOURCES = ["AUTOMATIC", "MANUAL"]
DIRECTIONS = ["UP", "DOWN"]

# Operating-company code -> name; any other code, and a null code, is UNKNOWN.
TOC_NAMES = {
    "20": "TransPennine Express",
    "23": "Arriva Trains Northern",
    "28": "East Midlands Trains",
    "29": "West Midlands Trains",
    "61": "London North Eastern Railway",
    "71": "Transport for Wales",
    "80": "Southeastern",
    "88": "Govia Thameslink Railway (Thameslink)",
}
UNKNOWN_COMPANY = "Unknown"

# Train-describer C-class message types kept by the berth projection.
TD_BERTH_TYPES = ["CA", "CB", "CC"]

LONDON = "Europe/London"

# ---------------------------------------------------------------------------
# Derived schemas
# ---------------------------------------------------------------------------

# Column documentation (own wording), attached as StructField comments.
COLUMN_DOCS = {
    "event_type": "ARRIVAL or DEPARTURE",
    "toc_id": "operating company code",
    "variation_status": "ON TIME, EARLY, LATE or OFF ROUTE",
    "uk_datetime": "event time as London ISO-8601 text with offset",
    "timestamp": "event time, epoch seconds",
    "processed_at": "time the message was processed",
    "actual_timestamp": "instant the event happened at the location",
    "gbtt_timestamp": "planned passenger-timetable time, epoch ms text",
    "loc_stanox": "location code of the event",
    "planned_timestamp": "planned working-timetable time, epoch ms text",
    "timetable_variation": "minutes early or late; 0 when off route",
    "train_id": "train identity at activation",
    "delay_monitoring_point": "true when the location is a delay monitoring point",
    "next_report_run_time": "running time to the next report point",
    "reporting_stanox": "location code of the reporting point; 00000 for manual reports",
    "correction_ind": "true when the report corrects an earlier one",
    "event_source": "AUTOMATIC or MANUAL",
    "train_file_address": "train file address, when present",
    "division_code": "operating company code of the division",
    "train_terminated": "true when the train completed its journey",
    "offroute_ind": "true when the location is not in the schedule",
    "train_service_code": "service code of the train",
    "auto_expected": "true when an automatic report is expected",
    "route": "exit route indicator",
    "planned_event_type": "ARRIVAL, DEPARTURE or DESTINATION",
    "next_report_stanox": "location code of the next expected report",
    "original_loc_stanox": "original location code when the location was revised",
    "original_loc_timestamp": "planned time at the original location",
    "current_train_id": "current train identity after a change",
    "platform": "platform, when reported",
    "direction_ind": "UP or DOWN",
    "line_ind": "line indicator",
    "uk_date": "London calendar date of actual_timestamp (partition)",
}

_TYPED = {
    "timestamp": T.DoubleType(),
    "actual_timestamp": T.TimestampType(),
    "uk_date": T.DateType(),
}

# Movements table: the 26 warehouse columns, the 6 staging-only columns and
# the London-date partition column.
TABLE_COLUMNS = WAREHOUSE_COLUMNS + STAGING_ONLY_FIELDS + ["uk_date"]


def _field(name: str) -> T.StructField:
    return T.StructField(name, _TYPED.get(name, T.StringType()), True,
                         {"comment": COLUMN_DOCS.get(name, "")})


MOVEMENTS_SCHEMA = T.StructType([_field(c) for c in TABLE_COLUMNS])

# Lake envelope: one JSON object per movement.
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("message_type", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("toc_id", T.StringType()),
    T.StructField("variation_status", T.StringType()),
    T.StructField("uk_datetime", T.StringType()),
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("processed_at", T.StringType()),
    T.StructField("raw_data", T.MapType(T.StringType(), T.StringType())),
])


def documented(df):
    """Attach ``COLUMN_DOCS`` as column comments (StructField metadata)."""
    from pyspark.sql import functions as F
    return df.select(*[F.col(c).alias(c, metadata={"comment": COLUMN_DOCS[c]})
                       if c in COLUMN_DOCS else F.col(c) for c in df.columns])
