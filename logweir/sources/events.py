"""The ``events`` table seen as raw network logs.

The projection is integer arithmetic and text only, so any engine gives the same
rows. Event time is 60 ms per event, because the table's own time spans 30 days
and no five-minute window of it would pass a threshold; ``real_time`` keeps it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# 2024-01-15 10:00:00 UTC
ORIGIN_MICROS = 1_705_312_800_000_000
EVENT_MICROS = 60_000

# {text}: the engine's name for text.
FIELDS = {
    "source_ip": """case when event_id % 97 = 0 then null when event_id % 10 < 3 then '10.0.0.7'
        when event_id % 10 = 3 then '203.0.113.9' when event_id % 10 = 4 then '192.168.1.20'
        when event_id % 10 = 5 then '172.16.5.5'
        else concat('10.1.', cast(user_id % 8 as {text}), '.', cast(user_id % 200 + 1 as {text})) end""",
    "destination_ip": """case when event_id % 10 = 3 then concat('192.168.0.', cast(event_id % 200 as {text}))
        when event_id % 10 = 7 then '10.0.0.7' when event_id % 10 = 8 then null
        else concat('8.8.', cast(user_id % 4 as {text}), '.8') end""",
    "source_port": "cast(1024 + event_id % 50000 as int)",
    "destination_port": """cast(case when event_id % 10 = 3 and event_type <> 'purchase' then 1000 + event_id % 700
        when event_type = 'purchase' then 22 when event_type = 'signup' then 3306 else 443 end as int)""",
    "protocol": "case when event_id % 11 = 0 then null else 'tcp' end",
    "severity": """case when event_id % 10 < 3 then 'info' when event_type = 'error' then 'Error'
        when event_type = 'purchase' then 'CRITICAL' when event_type = 'signup' then 'warning'
        when event_type = 'view' then null else 'trace' end""",
    "message": """case when event_id % 17 = 0 then null
        else concat(event_type, ' by user ', cast(user_id as {text})) end""",
    "log_level": "case when event_id % 4 = 0 then 'debug' end",
    "bytes_sent": """cast(case when event_id % 10 < 3 then 10000
        when event_id % 10 = 3 and event_type = 'purchase' then 2000000
        when event_id % 10 = 4 then 500000 else event_id % 1000 end as bigint)""",
    "bytes_received": "cast(case when event_id % 13 = 0 then null else event_id % 5000 end as bigint)",
    "response_time": """cast(case when event_id % 10 = 5 then 6000 + event_id % 100
        when event_id % 10 = 4 and event_type = 'view' then 7000 else event_id % 500 end as double)""",
    "connection_status": """case when event_id % 10 in (3, 5) or event_type = 'error' then 'FAILED'
        when event_type = 'view' then null else 'SUCCESS' end""",
    "log_source": "case when event_id % 3 = 0 then 'firewall' end",
    "hostname": "case when event_id % 2 = 0 then concat('host-', cast(user_id % 10 as {text})) end",
}
# Numbers as text, some of them unreadable, for the reject rules.
TEXT_BYTES = """case when event_id % 89 = 0 then 'abc' when event_id % 83 = 0 then '1.5'
        else cast({bytes_sent} as {text}) end"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_logs(
    events: DataFrame, real_time: bool = False, text_bytes: bool = False, spacing: int = EVENT_MICROS, copies: int = 1
) -> DataFrame:
    """Events, batch or stream, as raw logs plus ``event_id``.

    ``spacing`` (microseconds between events) and ``copies`` of each make the logs denser.
    """
    if copies > 1:
        events = events.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
    fields = {name: expr.format(text="string") for name, expr in FIELDS.items()}
    if text_bytes:
        fields["bytes_sent"] = TEXT_BYTES.format(text="string", bytes_sent=fields["bytes_sent"])
    if real_time:
        stamp = F.col("ts").cast("timestamp")
    else:
        stamp = F.timestamp_micros(F.lit(ORIGIN_MICROS) + F.col("event_id") * spacing)
    return events.select(
        "event_id", stamp.alias("timestamp"), *[F.expr(e).alias(n) for n, e in fields.items()]
    )
