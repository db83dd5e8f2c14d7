"""Alert rows, the actions and channels they call for, and their latest state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.operators.anomaly import FLAGS

# Actions, and notification channels per log severity.
DASHBOARD, AUTOSCALE, NOTIFICATION = "dashboard", "autoscale", "notification"
AUTOSCALE_LEVEL = "CRITICAL"
SIMPLE_AUTOSCALE_LOGS = 5000
CHANNELS = {
    "INFO": ("log",),
    "WARNING": ("log", "email"),
    "ERROR": ("log", "email", "slack"),
    "CRITICAL": ("log", "email", "slack", "sms", "autoscale"),
}
DEFAULT_CHANNELS = ("log",)
# What a stored verdict does to the alert of its window.
RAISE, CHANGE, CLEAR = "raise", "change", "clear"


def alert_id(*keys: Column) -> Column:
    """Hash of window start and keys: the same alert keeps its id over retries.

    The prefix keeps a NULL key apart from any text.
    """
    start = F.unix_micros(F.col("window_start")).cast("string")
    return F.sha2(F.concat_ws(":", start, *[F.coalesce(F.concat(F.lit("="), k), F.lit("-")) for k in keys]), 256)


# The columns of an alert in their order; id and message follow.
WINDOW_START, WINDOW_END = "window_start", "window_end"
COLUMNS = (
    WINDOW_START,
    WINDOW_END,
    "source_ip",
    "traffic_direction",
    "severity",
    "log_count",
    "failure_rate",
    "avg_response_time",
    "total_bytes_sent",
    "unique_destinations",
    "unique_ports",
    "anomaly_score",
    "anomaly_level",
    "detected_at",
    *FLAGS,
)


def verdicts(anomalies: DataFrame) -> DataFrame:
    """One row per window and key in the form of an alert, with ``is_anomaly``.

    A NULL source makes the message NULL, and a NULL verdict counts as none.
    """
    message = F.concat(
        F.lit("Network anomaly detected from "),
        F.col("source_ip"),
        F.lit(" - Level: "),
        F.col("anomaly_level"),
        F.lit(" - Score: "),
        F.col("anomaly_score").cast("string"),
    )
    bounds = {WINDOW_START: F.col("window.start"), WINDOW_END: F.col("window.end")}
    rows = anomalies.withColumns(bounds).withColumn("is_anomaly", F.coalesce("is_anomaly", F.lit(False)))
    return rows.select(
        *COLUMNS,
        alert_id(F.col("source_ip"), F.col("traffic_direction"), F.col("severity")).alias("alert_id"),
        message.alias("alert_message"),
        "is_anomaly",
    )


def raised(verdict_rows: DataFrame) -> DataFrame:
    return verdict_rows.filter("is_anomaly").drop("is_anomaly")


def alerts(anomalies: DataFrame) -> DataFrame:
    """One row per anomalous window and key. A NULL source makes the message NULL."""
    return raised(verdicts(anomalies))


def actions(rows: DataFrame, autoscale: Column | None = None, carry: Sequence[str] = ("alert_id",)) -> DataFrame:
    """One row per action: dashboard and notification always, autoscale on a condition."""
    if autoscale is None:
        autoscale = F.col("anomaly_level") == AUTOSCALE_LEVEL
    wanted = F.array(F.lit(DASHBOARD), F.when(autoscale, AUTOSCALE), F.lit(NOTIFICATION))
    return rows.select(*carry, F.explode(F.array_compact(wanted)).alias("action"))


def simple_actions(anomalies: DataFrame, autoscale_logs: int = SIMPLE_AUTOSCALE_LOGS) -> DataFrame:
    """The simple variant: dashboard always, autoscale above a log count."""
    wanted = F.array(F.lit(DASHBOARD), F.when(F.col("log_count") > autoscale_logs, AUTOSCALE))
    return anomalies.select("window", "source_ip", F.explode(F.array_compact(wanted)).alias("action"))


def channels(
    alert_rows: DataFrame, table: Mapping[str, Sequence[str]] = CHANNELS
) -> DataFrame:
    """One row per alert and notification channel, looked up by log severity."""
    lookup = F.create_map(
        *[x for name, row in table.items() for x in (F.lit(name), F.array(*[F.lit(c) for c in row]))]
    )
    found = F.coalesce(
        F.try_element_at(lookup, F.col("severity")), F.array(*[F.lit(c) for c in DEFAULT_CHANNELS])
    )
    return alert_rows.select("alert_id", "severity", F.explode(found).alias("channel"))


def latest(history: DataFrame, order: Sequence[str] = ("written_at", "batch_id")) -> DataFrame:
    """The last state of each alert in a history of verdicts; cleared alerts are left out.

    Only the order is aggregated; the rows it names are fetched by a join.
    """
    last = history.groupBy("alert_id").agg(F.max(F.struct(*order)).alias("last"))
    found = last.select(F.col("alert_id").alias("__id"), *[F.col(f"last.{c}").alias(f"__{c}") for c in order])
    same = F.col("alert_id") == F.col("__id")
    for c in order:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return history.join(found, same, "left_semi").filter("is_anomaly").drop("is_anomaly")
