"""Violation records made from a generic ``events`` table.

One violation per event, for data sets without violation records of their own.
Every column is a fixed arithmetic function of the event's id and user, chosen
so that all branches of the cleaning stage occur.  No event is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbscope.functions.text import literals

VIOLATION_TEXTS = (
    '["NO PARKING","PARKING ON FOOTPATH"]',
    "['DOUBLE PARKING']",
    '["WRONG PARKING"]',
    "NO PARKING",
    "no parking",
    '["JUMPING SIGNAL"]',
    "",
    None,
    '[" parking in a main road ","DEFECTIVE NUMBER PLATE"]',
    '["NO PARKING"]',
    '["PARKING NEAR ROAD CROSSING","XX PARKING"]',
)
VEHICLES = (
    "CAR",
    "SCOOTER",
    "bus (bmtc/ksrtc)",
    None,
    "SPACESHIP",
    "PASSENGER AUTO",
    "TANKER",
    "MOTOR CYCLE",
)


def _choice(texts: tuple[str | None, ...], key: str) -> str:
    return f"get(array({literals(texts)}), cast({key} % {len(texts)} as int))"


def violations_from_events(events: DataFrame) -> DataFrame:
    moved = "cast(ts as timestamp_ntz) - make_ym_interval(0, cast(event_id % 6 as int))"
    return events.selectExpr(
        "event_id as id",
        f"""case when event_id % 97 = 0 then 'not-a-date'
                 when event_id % 193 = 0 then null
                 else concat(left(cast({moved} as string), 19), '+00') end as created_datetime""",
        """case when event_id % 101 != 0 then
                 12.9D + ((user_id % 97) * (user_id % 97)) div 97 / 1000.0D
                 + (event_id % 9 - 4) / 10000.0D end as latitude""",
        """case when event_id % 103 != 0 then
                 77.5D + (event_id % 5) * (event_id % 3) / 1000.0D
                 + (event_id % 7 - 3) / 10000.0D end as longitude""",
        f"{_choice(VIOLATION_TEXTS, 'event_id')} as violation_type",
        f"{_choice(VEHICLES, 'event_id')} as vehicle_type",
        "case when event_id % 29 != 0 then concat('V', event_id % 400) end as vehicle_number",
        "case when user_id % 13 != 12 then concat('STN', user_id % 13) end as police_station",
        """case user_id % 6 when 0 then 'NO JUNCTION' when 1 then null when 2 then '  '
                 when 3 then 'No Junction'
                 else concat('JN', user_id % 6, '-', event_type) end as junction_name""",
    )


def read_event_violations(spark: SparkSession, folder: str) -> DataFrame:
    return violations_from_events(spark.read.parquet(f"{folder}/events.parquet"))
