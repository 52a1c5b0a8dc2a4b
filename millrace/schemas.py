"""Declared schemas of the commerce and rail domains (fixed values: names and types of the data model)."""

from __future__ import annotations

from pyspark.sql import types as T

COMMERCE = {
    "users": "user_id string, first_name string, last_name string, email string, phone_number string, "
    "created_at timestamp, updated_at timestamp, address_id string",
    "addresses": "address_id string, address string, zipcode bigint, state string, country string",
    "products": "product_id string, name string, price double, inventory bigint",
    "promos": "promo_id string, discount bigint, status string",
    "orders": "order_id string, user_id string, promo_id string, address_id string, created_at timestamp, "
    "order_cost double, shipping_cost double, order_total double, tracking_id string, "
    "shipping_service string, estimated_delivery_at timestamp, delivered_at timestamp, status string",
    "order_items": "order_id string, product_id string, quantity bigint",
    "events": "event_id string, session_id string, user_id string, page_url string, created_at timestamp, "
    "event_type string, order_id string, product_id string",
}

PARTITIONED_TABLES = ("events", "orders", "users")

MOVEMENT_TIMESTAMPS = ("actual_timestamp", "gbtt_timestamp", "original_loc_timestamp", "planned_timestamp")

MOVEMENT_FIELDS = (
    "actual_timestamp", "auto_expected", "correction_ind", "current_train_id", "delay_monitoring_point",
    "direction_ind", "division_code", "event_source", "event_type", "gbtt_timestamp", "line_ind",
    "loc_stanox", "next_report_run_time", "next_report_stanox", "offroute_ind", "original_loc_stanox",
    "original_loc_timestamp", "planned_event_type", "planned_timestamp", "platform", "reporting_stanox",
    "route", "timetable_variation", "toc_id", "train_id", "train_file_address", "train_service_code",
    "train_terminated", "variation_status",
)

OPERATING_COMPANIES = "toc_id int, company_name string"

CREATED, CREATED_DAY = "created_at", "created_at_day"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def commerce(table: str) -> T.StructType:
    return struct(COMMERCE[table])


def movements() -> T.StructType:
    """The 29 landed fields; four are timestamps, the rest text."""
    return T.StructType(
        [
            T.StructField(name, T.TimestampType() if name in MOVEMENT_TIMESTAMPS else T.StringType())
            for name in MOVEMENT_FIELDS
        ]
    )


def movement_message() -> T.StructType:
    """One feed message: a header and a body whose fields are all text."""
    header = T.StructType(
        [T.StructField("msg_type", T.StringType()), T.StructField("msg_queue_timestamp", T.StringType())]
    )
    body = T.StructType([T.StructField(name, T.StringType()) for name in MOVEMENT_FIELDS])
    return T.StructType([T.StructField("header", header), T.StructField("body", body)])
