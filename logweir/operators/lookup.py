"""Joins of logs with lookup tables.

All joins are equi-joins without a broadcast hint: Spark broadcasts a table whose
measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
shuffles. Adaptive execution splits the partition of a hot address, which it can do
because the lookup side is rebalanced: a side that ends in an aggregate on the join
key within the join's stage could not be repeated. Rows without an address get keys
of their own that match nothing, so they do not meet in one task. Networks are looked
up in one scan of the logs while they are few enough to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.functions.network import ipv4_number


#: Networks up to which addresses are looked up in broadcast tables, one for each prefix length.
NETWORKS = 100_000


def _hashable(logs: DataFrame) -> list[Column]:
    """Columns that can be hashed: a map, or what holds one, as its JSON text."""
    out = []
    for field in logs.schema.fields:
        mapped = "map<" in field.dataType.simpleString()
        # A dot in a name is part of it.
        column = F.col("`" + field.name.replace("`", "``") + "`")
        out.append(F.to_json(F.struct(column)) if mapped else column)
    return out


def _left_join(logs: DataFrame, found: DataFrame, column: str) -> DataFrame:
    """``logs`` with the columns of ``found`` (one row per ``column``)."""
    spread = F.concat(F.lit("\u0000"), F.xxhash64(*_hashable(logs)).cast("string"))
    right = found.withColumnRenamed(column, "__found").hint("rebalance")
    keyed = logs.withColumn("__key", F.coalesce(F.col(column), spread))
    return keyed.join(right, F.col("__key") == F.col("__found"), "left").drop("__key", "__found")


def join_assets(logs: DataFrame, assets: DataFrame) -> DataFrame:
    """Logs with the columns of the asset that owns the source address."""
    return _left_join(logs, assets, "source_ip")


def flag_threats(logs: DataFrame, threats: DataFrame) -> DataFrame:
    """``is_threat``: either address is in the ``ip`` column of the list.

    One join per address; a join on "either" would compare all pairs.
    """
    listed = threats.select("ip").filter(F.col("ip").isNotNull()).distinct()
    flagged = logs
    for column in ("source_ip", "destination_ip"):
        hits = listed.select(F.col("ip").alias(column), F.lit(True).alias(f"__{column}"))
        flagged = _left_join(flagged, hits, column)
    found = F.coalesce(F.col("__source_ip"), F.col("__destination_ip"), F.lit(False))
    return flagged.withColumn("is_threat", found).drop("__source_ip", "__destination_ip")


def _networks(ranges: DataFrame) -> DataFrame:
    """(bits, network, location): one row for each readable CIDR range."""
    bits = F.substring_index("cidr", "/", -1).try_cast("int")
    return (
        ranges.select(ipv4_number(F.substring_index("cidr", "/", 1)).alias("number"), bits.alias("bits"), "location")
        .filter(F.col("number").isNotNull() & F.col("bits").between(0, 32))
        .groupBy("bits", F.expr("shiftright(number, 32 - bits)").alias("network"))
        .agg(F.min("location").alias("location"))
    )


def locate(addresses: DataFrame, ranges: DataFrame) -> DataFrame:
    """``source_ip`` and ``location`` of each address that lies in a CIDR range.

    ``ranges`` has ``cidr`` and ``location``; the longest prefix wins. An address
    meets a range of length n exactly when their first n bits are equal, so each
    address gets one key per length that occurs (33 at most, the only thing read
    to the driver) and joins on equality.
    """
    networks = _networks(ranges)
    lengths = sorted(row.bits for row in networks.select("bits").distinct().collect())
    if not lengths:
        return addresses.select("source_ip", F.lit(None).cast("string").alias("location")).limit(0)
    number = ipv4_number(F.col("source_ip"))
    keys = (
        addresses.select("source_ip", number.alias("number"))
        .filter(F.col("number").isNotNull())
        .select("source_ip", "number", F.explode(F.array(*[F.lit(n) for n in lengths])).alias("bits"))
        .withColumn("network", F.expr("shiftright(number, 32 - bits)"))
    )
    return (
        keys.join(networks, ["bits", "network"])
        .groupBy("source_ip")
        .agg(F.max_by("location", "bits").alias("location"))
    )


def join_geo(logs: DataFrame, ranges: DataFrame, most: int = NETWORKS) -> DataFrame:
    """Logs with the location of their source address, NULL outside all ranges.

    Up to ``most`` networks the logs are scanned once: for each prefix length that occurs, 33 at
    most, their addresses meet a broadcast table of its networks, and the longest match counts.
    With more networks each distinct address is located by shuffled joins, and the result is
    joined back by address. The rows are the same.
    """
    networks = _networks(ranges).limit(most + 1).collect()
    if len(networks) > most:
        return _left_join(logs, locate(logs.select("source_ip").distinct(), ranges), "source_ip")
    by_length: dict[int, list[tuple]] = {}
    for row in networks:
        by_length.setdefault(row.bits, []).append((row.network, row.location))
    found = logs.withColumn("__number", ipv4_number(F.col("source_ip")))
    names = []
    for bits in sorted(by_length, reverse=True):
        kind = f"__network bigint, __location{bits} string, __in{bits} boolean"
        rows = [(network, location, True) for network, location in by_length[bits]]
        table = logs.sparkSession.createDataFrame(rows, kind)
        prefix = F.shiftright("__number", 32 - bits)
        found = found.join(F.broadcast(table), prefix == F.col("__network"), "left").drop("__network")
        names.append(bits)
    location = F.lit(None).cast("string")
    for bits in reversed(names):
        # A network without a location still is the longest match.
        location = F.when(F.col(f"__in{bits}"), F.col(f"__location{bits}")).otherwise(location)
    made = ["__number", *[f"__{kind}{bits}" for bits in names for kind in ("location", "in")]]
    return found.withColumn("location", location).drop(*made)
