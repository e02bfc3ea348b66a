"""Explicit schemas of the warehouse targets and the staging table.

Targets are fixed (no inference): every writer selects and casts to these.
varchar(n) limits are kept as ``MAX_LENGTH`` for the length check; Parquet
tables cannot enforce them.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
MONEY = T.DecimalType(10, 2)


def _struct(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


PRODUCT = _struct(
    ("productid", L, False),
    ("product_name", S, True),
    ("product_type", S, True),
    ("category", S, True),
    ("subcategory", S, True),
    ("status", S, True),
    ("alcohol_content_ml", D, True),
)

MEMBER = _struct(("memberid", L, False), ("gender", S, True), ("is_active", B, True))

ROOM = _struct(("roomid", L, False), ("room_name", S, True))

TIME = _struct(
    ("timeid", L, False),
    ("year", I, True),
    ("month", I, True),
    ("day", I, True),
    ("time_of_day", S, True),
    ("season", S, True),
    ("day_of_week", S, True),
    ("is_weekday", S, True),
    ("holiday", S, True),
    ("event", S, True),
)

SALESFACT = _struct(
    ("timeid", L, False),
    ("productid", L, False),
    ("memberid", L, False),
    ("roomid", L, False),
    ("kroner_sales", MONEY, True),
    ("unit_sales", I, True),
)

STAGED_SALE = _struct(
    ("year", I, True),
    ("month", I, True),
    ("season", S, True),
    ("day", I, True),
    ("day_of_week", S, True),
    ("time_of_day", S, True),
    ("product_name", S, True),
    ("room_name", S, True),
    ("gender", S, True),
    ("is_active", B, True),
    ("kroner_sales", MONEY, True),
    ("unit_sales", L, True),
)

# Varchar limits of the warehouse DDL, per table and column.
MAX_LENGTH = {
    "product": {"product_name": 100, "product_type": 100, "category": 100,
                "subcategory": 100, "status": 10},
    "member": {"gender": 20},
    "room": {"room_name": 100},
    "time": {"time_of_day": 10, "season": 10, "day_of_week": 10, "is_weekday": 10,
             "holiday": 50, "event": 50},
}

# What identifies a member to a lookup. Rooms are inserted unconditionally, so
# their names may repeat.
NATURAL_KEYS = {
    "product": ["product_name"],
    "member": ["gender", "is_active"],
    "time": ["year", "month", "day", "time_of_day"],
}

# Primary and foreign keys of the warehouse DDL.
PRIMARY_KEYS = {
    "product": ["productid"],
    "member": ["memberid"],
    "room": ["roomid"],
    "time": ["timeid"],
    "salesfact": ["timeid", "productid", "memberid", "roomid"],
}
FOREIGN_KEYS = {
    "salesfact": [("timeid", "time", "timeid"), ("productid", "product", "productid"),
                  ("memberid", "member", "memberid"), ("roomid", "room", "roomid")],
}

# Money column precision of the fact and staging tables.
MONEY_PRECISION, MONEY_SCALE = 10, 2
