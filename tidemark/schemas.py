"""Record layouts.  Schemas are always declared, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

RATE = T.StructType(
    [
        T.StructField("ts", T.LongType()),
        T.StructField("hbdm", T.StringType()),
        T.StructField("num", T.IntegerType()),
    ]
)

#: The same record as it travels in JSON, where the time field is ``timestamp``.
RATE_MESSAGE = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("hbdm", T.StringType()),
        T.StructField("num", T.IntegerType()),
    ]
)

ORDER = T.StructType(
    [
        T.StructField("ts", T.LongType()),
        T.StructField("catlog", T.StringType()),
        T.StructField("subcat", T.IntegerType()),
        T.StructField("hbdm", T.StringType()),
        T.StructField("value", T.IntegerType()),
    ]
)

COMMAND_LOG = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "ts",
            "type",
            "serialnumber",
            "task_id",
            "waybill_id",
            "command_type",
            "message",
            "dt",
        )
    ]
)

DEVICE_EVENT = T.StructType(
    [
        T.StructField("time", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("severity_level", T.IntegerType()),
        T.StructField("source_type", T.IntegerType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("code", T.StringType()),
    ]
)

# The allowed log types of a command log record.
LOG_TYPES = (
    "AIRPORT",
    "DRONE",
    "AIRPORT_ACK",
    "DRONE_ACK",
    "AIRPORT_RETRY",
    "DRONE_RETRY",
)

# The allowed command types of a command log record.
COMMAND_TYPES = (
    "ATT_REQ_TO_RESERVE_CUPBOARD",
    "ATT_REQ_TO_OPEN_GATE",
    "ATT_REQ_TO_PLACE_CARGO",
    "ATT_CARGO_ARRIVED_AIRPORT",
    "ATT_REQ_TO_CLOSE_GATE",
    "ATT_RES_TO_OPEN_CUPBOARD",
    "ATT_FORCE_TO_OPEN_CUPBOARD",
    "DTT_START_FLIGHT_TRAJECTORY",
    "DTT_UNMOUNT_BOX",
)
