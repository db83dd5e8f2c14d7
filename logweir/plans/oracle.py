"""The same results as plain SQL over the same tables, for comparison."""

from __future__ import annotations

from logweir.plans import queries as Q
from logweir.sources import events as S

PRIVATE = r"regexp_matches({0}, '^(10\.|192\.168\.|172\.(1[6-9]|2[0-9]|3[01])\.)')"
KEYS = "source_ip, traffic_direction, severity"


def _raw(real_time: bool = False, text_bytes: bool = False, spacing: int = S.EVENT_MICROS, copies: int = 1) -> str:
    fields = {name: expr.format(text="varchar") for name, expr in S.FIELDS.items()}
    if text_bytes:
        fields["bytes_sent"] = S.TEXT_BYTES.format(text="varchar", bytes_sent=fields["bytes_sent"])
    stamp = "ts" if real_time else f"make_timestamp({S.ORIGIN_MICROS} + event_id * {spacing})"
    columns = ",\n".join(f"{expr} as {name}" for name, expr in fields.items())
    return f"select event_id, {stamp} as \"timestamp\",\n{columns}\nfrom events" + (f", range({copies}) as again" if copies > 1 else "")


def _internal(column: str) -> str:
    return f"coalesce({PRIVATE.format(column)}, false)"


def _direction() -> str:
    src, dst = _internal("source_ip"), _internal("destination_ip")
    return f"""case when {src} and {dst} then 'internal' when {src} then 'outbound'
        when {dst} then 'inbound' else 'external' end"""


def _term(condition: str, weight: str) -> str:
    return f"(case when {condition} then {weight}::double else 0::double end)"


def _risk(sent: str) -> str:
    terms = (
        _term("destination_port in (22, 23, 3389, 1433, 3306, 5432)", "0.3"),
        _term(f"not {_internal('source_ip')}", "0.2"),
        _term(f"{sent} > 1000000", "0.2"),
        _term("connection_status = 'FAILED'", "0.3"),
    )
    return f"least({' + '.join(terms)}, 1.0::double)"


def _topic(severity: str) -> str:
    return f"""case upper({severity}) when 'CRITICAL' then 'network-logs-critical'
        when 'ERROR' then 'network-logs-error' when 'WARNING' then 'network-logs-warning'
        when 'DEBUG' then 'network-logs-debug' else 'network-logs-info' end"""


def _key() -> str:
    return "nullif(split_part(coalesce(source_ip, 'unknown'), '.', -1), '')"


def _enrich(source: str, sent: str = "bytes_sent") -> str:
    number = f"coalesce({sent}, 0)"
    return f"""select event_id, "timestamp", source_ip, destination_ip, source_port, destination_port,
        upper(coalesce(protocol, 'TCP')) as protocol, upper(coalesce(severity, 'INFO')) as severity,
        coalesce(message, '') as message, upper(coalesce(log_level, 'INFO')) as log_level,
        {number} as bytes_sent, coalesce(bytes_received, 0) as bytes_received,
        coalesce(response_time, 0::double) as response_time_ms,
        coalesce(connection_status, 'UNKNOWN') as connection_status,
        make_timestamp({Q.NOW_MICROS}) as ingestion_time,
        strftime(make_timestamp({Q.NOW_MICROS}), '%Y-%m-%d') as processing_date,
        coalesce(log_source, 'unknown') as log_source, coalesce(hostname, '{Q.HOST}') as hostname,
        '1.0' as data_version, {_internal('source_ip')} as is_internal_ip,
        {_direction()} as traffic_direction, {_risk(number)} as risk_score
        from {source}"""


def _log(**options) -> str:
    return f"with raw as ({_raw(**options)}), log as ({_enrich('raw')} where source_ip is not null)"


LOG = _log()

_JSON_FIELDS = (
    "timestamp source_ip destination_ip source_port destination_port protocol severity message log_level "
    "bytes_sent bytes_received response_time_ms connection_status ingestion_time processing_date log_source "
    "hostname data_version is_internal_ip traffic_direction risk_score"
).split()


def _json(fields: list[str]) -> str:
    def text(name: str) -> str:
        if name in ("timestamp", "ingestion_time"):
            return f"strftime(\"{name}\", '%Y-%m-%dT%H:%M:%S.%fZ')"
        return name

    return f"json_object({', '.join(f'{chr(39)}{n}{chr(39)}, {text(n)}' for n in fields)})::varchar"


RECORDS = f"""select event_id, {_topic('severity')} as topic, {_key()} as key, {_json(_JSON_FIELDS)} as value"""

# Text bytes: the readable numbers, and the reason a row is rejected.
_SENT = "try_cast(bytes_sent as bigint)"
_READABLE = "regexp_matches(bytes_sent, '^[0-9]+$')"
CHECKED = f"""with raw as ({_raw(text_bytes=True)}), checked as (select *,
    case when bytes_sent is not null and not {_READABLE} then 'bad_bytes_sent'
         when source_ip is null then 'missing_source_ip' end as reject_reason from raw),
    readable as (select * replace (case when {_READABLE} then {_SENT} end as bytes_sent) from checked
        where reject_reason is null),
    log as ({_enrich('readable')}), sent as ({RECORDS} from log)"""

_SPREAD = f"""{LOG}, every as (
    select *, (epoch_us("timestamp") - epoch_us("timestamp") % 60000000) - k * 60000000 as window_start
    from log, (select unnest([0, 1, 2, 3, 4]) as k) w)"""
_PART = f"event_id * {Q.REPLAYS} // (select max(event_id) + 1 from events)"
_MOVED = f"(event_id % {Q.LATE_EVERY} = {Q.LATE_EVENT})"
# The watermark when the last file comes: two minutes before the last log of the files before.
_MARK = f"""(select max(epoch_us("timestamp")) - 120000000 from log
    where {_PART} < {Q.REPLAYS - 1} and not {_MOVED})"""


def _metrics(kept: str = "true") -> str:
    return f"""{_SPREAD}, spread as (select * from every where {kept}),
 metric as (select window_start, window_start + 300000000 as window_end, {KEYS},
    count(*) as log_count, sum(bytes_sent)::bigint as total_bytes_sent,
    sum(bytes_received)::bigint as total_bytes_received, avg(response_time_ms) as avg_response_time,
    max(response_time_ms) as max_response_time, min(response_time_ms) as min_response_time,
    count(distinct destination_ip) as unique_destinations, count(distinct destination_port) as unique_ports,
    count(*) filter (where connection_status = 'FAILED') as failed_connections,
    avg(risk_score) as avg_risk_score, max(risk_score) as max_risk_score
    from spread group by window_start, {KEYS}),
 derived as (select *, failed_connections::double / log_count as failure_rate,
    (total_bytes_sent + total_bytes_received) / 300::double as bytes_per_second,
    log_count > 1000 as is_high_volume, avg_response_time > 5000 as is_high_latency,
    failed_connections::double / log_count > 0.1::double as is_suspicious_failure_rate from metric),
 flagged as (select *, log_count > 1000 as high_volume_anomaly, avg_response_time > 5000 as high_latency_anomaly,
    failure_rate > 0.1::double as high_failure_rate_anomaly, total_bytes_sent > 10485760 as data_exfiltration_anomaly,
    unique_ports > 50 as port_scanning_anomaly, max_risk_score > 0.8::double as high_risk_anomaly from derived),
 scored as (select *, high_volume_anomaly::int * 0.2::double + high_latency_anomaly::int * 0.15::double
    + high_failure_rate_anomaly::int * 0.25::double + data_exfiltration_anomaly::int * 0.3::double
    + port_scanning_anomaly::int * 0.05::double + high_risk_anomaly::int * 0.05::double as anomaly_score
    from flagged),
 anomaly as (select *, anomaly_score > 0.3::double as is_anomaly,
    case when anomaly_score > 0.7::double then 'CRITICAL' when anomaly_score > 0.5::double then 'HIGH'
         when anomaly_score > 0.3::double then 'MEDIUM' else 'LOW' end as anomaly_level from scored),
 alert as (select *, sha256(concat_ws(':', window_start::varchar, coalesce('=' || source_ip, '-'),
        coalesce('=' || traffic_direction, '-'), coalesce('=' || severity, '-'))) as alert_id,
    'Network anomaly detected from ' || source_ip || ' - Level: ' || anomaly_level
        || ' - Score: ' || anomaly_score::varchar as alert_message
    from anomaly where is_anomaly)"""


METRICS = _metrics()
LATE_METRICS = _metrics(f"not ({_MOVED} and {_PART} < {Q.REPLAYS - 1} and window_start + 300000000 <= {_MARK})")

_ALERT = f"""select window_start, window_end, {KEYS}, log_count,
    round(failure_rate, 9) as failure_rate, round(avg_response_time, 9) as avg_response_time, total_bytes_sent,
    unique_destinations, unique_ports, anomaly_score, anomaly_level, {Q.NOW_MICROS}::bigint as detected_at,
    high_volume_anomaly, high_latency_anomaly, high_failure_rate_anomaly, data_exfiltration_anomaly,
    port_scanning_anomaly, high_risk_anomaly, alert_id, alert_message from alert"""
ALERTS = f"{METRICS} {_ALERT}"
_DERIVED = """select * replace (round(avg_response_time, 9) as avg_response_time,
    round(avg_risk_score, 9) as avg_risk_score, round(failure_rate, 9) as failure_rate,
    round(bytes_per_second, 9) as bytes_per_second) from derived"""
_CLOSED = """window_end <= (select max(epoch_us("timestamp")) - {0} from {1})"""


def _result_records(condition: str) -> str:
    return f"""{METRICS}, measured as ({_DERIVED} where {condition}),
        alerted as (select * from ({_ALERT}) a where {condition})
        select 'processed-metrics' as topic, {_key()} as key, * from measured
        union all by name select 'network-alerts' as topic, {_key()} as key, * from alerted"""



def _simple(source: str = "raw", **options) -> str:
    return f"""{_log(**options)}, spread as (
    select *, (epoch_us("timestamp") - epoch_us("timestamp") % 60000000) - k * 60000000 as window_start
    from {source}, (select unnest([0, 1, 2, 3, 4]) as k) w),
 metric as (select window_start, window_start + 300000000 as window_end, source_ip, count(*) as log_count,
    round(avg({_time(source)}), 9) as avg_response_time, max({_time(source)}) as max_response_time
    from spread group by window_start, source_ip)"""


def _time(source: str) -> str:
    return "response_time" if source == "raw" else "response_time_ms"


SIMPLE = _simple()

_BROKEN = "(" + " or ".join(f"event_id % {n} = 0" for n in (71, 73, 79, 67, 61)) + ")"
_DAMAGED = f"""case when event_id % 71 = 0 then substr(value, 1, 20) when event_id % 73 = 0 then '[]'
    when event_id % 79 = 0 then null
    when event_id % 67 = 0 then replace(value, '"timestamp":"2024', '"timestamp":"soon')
    when event_id % 61 = 0 then '{{"severity":"INFO"}}' else value end"""
_QUEUE = f"""(event_id % {Q.PARTITIONS})::int as "partition", event_id // {Q.PARTITIONS} as "offset" """
_EVENT_MICROS = f"{S.ORIGIN_MICROS} + event_id * {S.EVENT_MICROS}"

_FLAT_LOG = ", ".join(
    f'epoch_us("{n}") as "{n}"' if n in ("timestamp", "ingestion_time") else n for n in _JSON_FIELDS
)

ASSETS = """select concat('10.1.', cast(c_custkey % 8 as varchar), '.', cast(c_custkey % 200 + 1 as varchar)) as source_ip,
    min(c_name) as owner, min(c_mktsegment) as segment from customer group by 1"""
RANGES = """select concat('10.1.', n_nationkey::varchar, '.0/24') as cidr, n_name as location from nation
    union all select concat('172.', n_nationkey::varchar, '.0.0/16'), n_name from nation
    union all select concat((r_regionkey + 9)::varchar, '.0.0.0/8'), r_name from region"""


def _number(ip: str) -> str:
    parts = [f"split_part({ip}, '.', {i})::bigint * {256 ** (4 - i)}" for i in range(1, 5)]
    return "(" + " + ".join(parts) + ")"


GEO = f"""with raw as ({_raw()}), bound as (select location, split_part(cidr, '/', 2)::int as bits,
    {_number("split_part(cidr, '/', 1)")} as low from ({RANGES}) r),
 address as (select source_ip, {_number('source_ip')} as number from
    (select distinct source_ip from raw where source_ip is not null) d),
 found as (select source_ip, arg_max(location, bits) as location from address
    join bound on number between low and low + (1::bigint << (32 - bits)) - 1 group by source_ip)
 select event_id, raw.source_ip, location from raw left join found on raw.source_ip = found.source_ip"""

THREATS = """select distinct case when s_suppkey % 2 = 0
    then concat('10.1.', cast(s_suppkey % 8 as varchar), '.', cast(s_suppkey % 200 + 1 as varchar))
    else concat('8.8.', cast(s_suppkey % 4 as varchar), '.8') end as ip from supplier"""

ZSCORES = f"""{METRICS}, center as (select source_ip as k, avg(log_count) as mean, stddev_samp(log_count) as deviation,
    median(log_count) as middle from metric group by source_ip),
 spread_by as (select k, median(abs(log_count - middle)) as mad from metric join center on source_ip = k group by k),
 z as (select window_start, window_end, {KEYS}, log_count,
    case when deviation > 0 then (log_count - mean) / deviation end as zscore,
    case when mad > 0 then (log_count - middle) * 0.6745::double / mad end as modified_zscore
    from metric join center c on source_ip = c.k join spread_by s on s.k = c.k)
 select * replace (round(zscore, 9) as zscore, round(modified_zscore, 9) as modified_zscore),
    abs(zscore) > 3 as is_zscore_outlier, abs(modified_zscore) > 3.5::double as is_modified_zscore_outlier from z"""

SEASONAL = f"""with raw as ({_raw(real_time=True)}), log as ({_enrich('raw')} where source_ip is not null),
 hourly as (select traffic_direction, date_trunc('hour', "timestamp") as hour, count(*) as log_count
    from log group by 1, 2),
 trended as (select *, avg(log_count) over (partition by traffic_direction order by hour
    rows between 50 preceding and 49 following) as trend from hourly),
 seasoned as (select *, avg(log_count - trend) over (partition by traffic_direction, extract(hour from hour))
    as seasonal from trended)
 select traffic_direction, epoch_us(hour) as hour, log_count, round(trend, 9) as trend,
    round(seasonal, 9) as seasonal, round(log_count - trend - seasonal, 9) as residual from seasoned"""

SEASONAL_CALENDAR = f"""with raw as ({_raw(real_time=True)}), log as ({_enrich('raw')} where source_ip is not null),
 found as (select traffic_direction, date_trunc('hour', "timestamp") as hour, count(*) as log_count
    from log where extract(hour from "timestamp") not in {Q.SILENT_HOURS} group by 1, 2),
 calendar as (select traffic_direction, unnest(generate_series(min(hour), max(hour), interval 1 hour)) as hour
    from found group by 1),
 hourly as (select c.traffic_direction, c.hour, coalesce(log_count, 0) as log_count from calendar c
    left join found f on f.hour = c.hour and f.traffic_direction is not distinct from c.traffic_direction),
 trended as (select *, avg(log_count) over (partition by traffic_direction order by hour
    rows between 50 preceding and 49 following) as trend from hourly),
 seasoned as (select *, avg(log_count - trend) over (partition by traffic_direction, extract(hour from hour))
    as seasonal from trended)
 select traffic_direction, epoch_us(hour) as hour, log_count, round(trend, 9) as trend,
    round(seasonal, 9) as seasonal, round(log_count - trend - seasonal, 9) as residual from seasoned"""


def _raw_select(columns: str, **options) -> str:
    return f"with raw as ({_raw(**options)}) select {columns} from raw"


def _masked(column: str) -> str:
    return rf"regexp_replace({column}, '^([0-9]{{1,3}}[.][0-9]{{1,3}}[.][0-9]{{1,3}})[.][0-9]{{1,3}}$', '\1.0')"


_FEATURES = (
    "log_count avg_response_time failure_rate total_bytes_sent unique_destinations unique_ports max_risk_score".split()
)
#: Trees of such samples are no deeper: the levels are ceil(log2(rows of the tree)) and one more.
_LEVELS = {64: 9, 256: 11}


def _chance(*parts: str) -> str:
    text = " || ':' || ".join(f"({p})::varchar" for p in parts)
    return f"('0x' || substr(md5({text}), 1, 13))::bigint / {2.0**52!r}::double"


def _forest(trees: int, sample: int) -> str:
    """The isolation forest level by level: draws, nodes, then the path of every row."""
    seed, levels = "42", _LEVELS[sample]
    gap = f"floor(ln(1.0::double - {_chance(seed, 'id', 'k')}) / scale)"
    # The k-th tree of a row lies k + the gaps up to k behind the first.
    draws = [
        f"gaps as (select id, k, {gap} as gap from item, chance, (select unnest(range({trees})) as k) t where share < 1)",
        f"""drawn as materialized (select id, spot::int as tree from (select id, k + sum(gap) over
            (partition by id order by k rows unbounded preceding) as spot from gaps) s where spot < {trees})""",
    ]
    drawn = "select tree, id, v from drawn join item using (id)"
    every = f"select unnest(range({trees}))::int as tree, id, v from item, chance where share >= 1"
    value = "case feature " + " ".join(f"when {i} then v[{i + 1}]" for i in range(len(_FEATURES))) + " end"
    n = len(_FEATURES)
    low, high = ([f"{f}(v[{i + 1}])" for i in range(n)] for f in ("min", "max"))
    parts = [
        f"""item as (select *, sha256(concat_ws(':', window_start::varchar, coalesce('=' || source_ip, '-'),
            coalesce('=' || traffic_direction, '-'), coalesce('=' || severity, '-'))) as id,
            [{', '.join(f'coalesce({f}, 0)::double' for f in _FEATURES)}] as v from derived)""",
        f"""chance as (select least(1.0::double, {float(sample)}::double / count(*)) as share,
            case when least(1.0::double, {float(sample)}::double / count(*)) < 1
                then ln(1.0::double - {float(sample)}::double / count(*)) end as scale from item)""",
        *draws,
        f"point as materialized ({drawn} union all {every})",
        "size as materialized (select tree, count(*) as n, ceil(log2(greatest(count(*), 2)))::int as deepest from point group by tree)",
        "rows0 as materialized (select tree, '' as path, v from point)",
    ]
    for k in range(levels):
        parts.append(
            f"""stat{k} as materialized (select tree, path, count(*) as n, [{', '.join(low)}] as low, [{', '.join(high)}] as high
                from rows{k} group by tree, path)"""
        )
        parts.append(
            f"""varied{k} as (select s.*, [x for x in range({n}) if high[x + 1] > low[x + 1]] as varied, deepest
                from stat{k} s join size using (tree))"""
        )
        parts.append(
            f"""picked{k} as (select *, case when {k} < deepest and len(varied) > 0 then
                varied[1 + floor({_chance(seed, 'tree', 'path', "'feature'")} * len(varied))::int] else -1 end as feature
                from varied{k})"""
        )
        parts.append(
            f"""node{k} as materialized (select tree, path, n, feature, case when feature >= 0 then low[feature + 1]
                + {_chance(seed, 'tree', 'path', "'cut'")} * (high[feature + 1] - low[feature + 1]) end as cut from picked{k})"""
        )
        parts.append(
            f"""rows{k + 1} as materialized (select tree, path || case when {value} <= cut then 'L' else 'R' end as path, v
                from rows{k} join node{k} using (tree, path) where feature >= 0)"""
        )
    # Every row from the root of every tree; a row that reaches a leaf stays there.
    parts.append("at0 as materialized (select id, v, tree, '' as path, size.n as total from item, size)")
    leaves = []
    mean = "case when {0} > 2 then 2.0 * (ln({0} - 1.0::double) + 0.5772156649015329::double) - 2.0 * ({0} - 1.0::double) / {0} when {0} = 2 then 1.0 else 0.0 end"
    for k in range(levels):
        leaves.append(f"select id, ({k} + {mean.format('n')}) / greatest({mean.format('total')}, 1.0) as depth from at{k} join node{k} using (tree, path) where feature < 0")
        parts.append(
            f"""at{k + 1} as materialized (select id, v, tree, path || case when {value} <= cut then 'L' else 'R' end as path, total
                from at{k} join node{k} using (tree, path) where feature >= 0)"""
        )
    parts.append(f"leaf as ({' union all '.join(leaves)})")
    parts.append(f"score as (select id, round(pow(2.0::double, -sum(depth) / {trees}), 9) as isolation_score from leaf group by id)")
    parts.append(
        """ranked as (select isolation_score, row_number() over (order by isolation_score) as r, count(*) over () as n from score)"""
    )
    parts.append("cut_at as (select isolation_score as cut from ranked where r = ceil(0.9::double * n))")
    columns = ", ".join(["window_start", "window_end", KEYS, *_FEATURES])
    return (
        f"{METRICS}, "
        + ", ".join(parts)
        + f""" select {columns}, isolation_score, round(isolation_score * 1e9)::bigint > (select round(cut * 1e9)::bigint from cut_at)
            as is_isolated from item join score using (id)"""
    )


def catalog() -> dict[str, str]:
    nonnull = " + ".join(
        f"count({n})"
        for n in (
            '"timestamp" source_ip destination_ip source_port destination_port protocol severity message '
            "log_level bytes_sent bytes_received response_time connection_status log_source hostname"
        ).split()
    )
    return {
        "enrich_logs": f"with raw as ({_raw()}), log as ({_enrich('raw')}) select event_id, {_FLAT_LOG} from log",
        "ingest_rejects": f"""{CHECKED} select event_id, source_ip, bytes_sent, reject_reason
            from checked where reject_reason is not null""",
        "internal_ip": _raw_select(
            f"event_id, {_internal('source_ip')} as source_internal, "
            f"{_internal('destination_ip')} as destination_internal"
        ),
        "traffic_direction": _raw_select(f"event_id, {_direction()} as traffic_direction"),
        "risk_score": _raw_select(f"event_id, {_risk('bytes_sent')} as risk_score"),
        "topic_routing": _raw_select(f"event_id, {_topic('severity')} as topic"),
        "partition_key": _raw_select(f"event_id, {_key()} as key"),
        "producer_records": f"{LOG} {RECORDS} from log",
        "producer_records_simple": f"""with raw as ({_raw()}), timed as
            (select *, make_timestamp({Q.NOW_MICROS}) as ingestion_time from raw)
            select 'network-logs' as topic, coalesce(source_ip, 'default') as key,
            {_json(['timestamp', 'source_ip', 'severity', 'message', 'ingestion_time'])} as value from timed""",
        "ingest_summary": f"""{CHECKED}, counted as (select count(*) as total,
            count(*) filter (where reject_reason is null) as success,
            count(*) filter (where reject_reason is not null) as failed from checked)
            select total, success, failed, (select sum(strlen(value)) from sent)::bigint as bytes_sent,
            success::double / total as success_rate from counted""",
        "ingest_by_topic": f"""{CHECKED} select topic, count(*) as success, sum(strlen(value))::bigint as bytes_sent
            from sent group by topic""",
        "parse_logs": f"""{LOG} select {_topic('severity')} as topic, {_QUEUE},
            {_EVENT_MICROS} as kafka_timestamp, {_FLAT_LOG} from log where not {_BROKEN}""",
        "parse_rejects": f"""{LOG}, sent as ({RECORDS} from log)
            select {_QUEUE}, {_DAMAGED} as value,
            case when event_id % 71 = 0 then 'not_json' when event_id % 73 = 0 then 'not_an_object'
                 when event_id % 79 = 0 then 'null_value' when event_id % 67 = 0 then 'bad_timestamp'
                 else 'missing_timestamp' end as parse_reason from sent where {_BROKEN}""",
        "consumed_records": f"""{LOG}, sent as ({RECORDS} from log)
            select topic, {_QUEUE}, {_EVENT_MICROS} as "timestamp", key, value,
            (case when event_id % 5 = 0 then 1 else 0 end)::int as n_headers,
            case when event_id % 5 = 0 then topic end as trace from sent""",
        "consumed_simple": f"{LOG} select {_QUEUE}, {_FLAT_LOG} from log",
        "windowed_metrics": f"""{METRICS} select * replace (round(avg_response_time, 9) as avg_response_time,
            round(avg_risk_score, 9) as avg_risk_score) from metric""",
        "derived_metrics": f"""{METRICS} select window_start, window_end, {KEYS},
            round(failure_rate, 9) as failure_rate, round(bytes_per_second, 9) as bytes_per_second,
            is_high_volume, is_high_latency, is_suspicious_failure_rate from derived""",
        "anomaly_flags": f"""{METRICS} select window_start, window_end, {KEYS}, high_volume_anomaly,
            high_latency_anomaly, high_failure_rate_anomaly, data_exfiltration_anomaly, port_scanning_anomaly,
            high_risk_anomaly from flagged""",
        "anomaly_scores": f"""{METRICS} select window_start, window_end, {KEYS}, anomaly_score, is_anomaly,
            anomaly_level from anomaly""",
        "alerts": ALERTS,
        "alert_actions": f"""{METRICS} select alert_id, 'dashboard' as action from alert
            union all select alert_id, 'notification' from alert
            union all select alert_id, 'autoscale' from alert where anomaly_level = 'CRITICAL'""",
        "alert_channels": f"""{METRICS} select alert_id, severity, unnest(case severity
            when 'WARNING' then ['log', 'email'] when 'ERROR' then ['log', 'email', 'slack']
            when 'CRITICAL' then ['log', 'email', 'slack', 'sms', 'autoscale'] else ['log'] end) as channel
            from alert""",
        "simple_metrics": f"{SIMPLE} select * from metric",
        "simple_anomalies": f"{SIMPLE} select * from metric where log_count > 1000 or avg_response_time > 5000",
        "simple_alert_actions": f"""{_simple(spacing=Q.DENSE_MICROS, copies=Q.DENSE_COPIES)}, found as
            (select * from metric where log_count > 1000 or avg_response_time > 5000)
            select window_start, window_end, source_ip, 'dashboard' as action from found union all
            select window_start, window_end, source_ip, 'autoscale' from found where log_count > 5000""",
        "metrics_records": _result_records("true"),
        "null_skip": _raw_select('event_id, epoch_us("timestamp") as "timestamp", source_ip, severity')
        + ' where "timestamp" is not null and source_ip is not null and severity is not null',
        "data_quality": f"""{CHECKED}, shares as (select count(*) as total_rows,
            ({nonnull})::double / (count(*) * 15) as completeness,
            (count(*) filter (where reject_reason is null))::double / count(*) as quality from checked)
            select *, completeness >= 0.85::double as completeness_ok, quality >= 0.90::double as quality_ok
            from shares""",
        "late_logs": _raw_select(
            'event_id, epoch_us("timestamp") as "timestamp", '
            'epoch_us("timestamp") + (event_id % 15) * 60000000 as ingestion_time'
        )
        + " where event_id % 15 > 10",
        "failed_attempts": f"""{_log(spacing=Q.DENSE_MICROS)}, failing as (select epoch_us("timestamp") - epoch_us("timestamp") % 60000000
            as window_start, source_ip, count(*) as failed_connections from log
            where connection_status = 'FAILED' group by 1, 2)
            select window_start, window_start + 60000000 as window_end, source_ip, failed_connections
            from failing where failed_connections > 100""",
        "partition_columns": _raw_select(
            'event_id, epoch_us("timestamp") as "timestamp", year("timestamp")::int as year, '
            'month("timestamp")::int as month, day("timestamp")::int as day, hour("timestamp")::int as hour',
            real_time=True,
        ),
        "retention": _raw_select('event_id, epoch_us("timestamp") as "timestamp"', real_time=True)
        + " where \"timestamp\" >= timestamp '2024-04-14 12:00:00' - interval 90 day",
        "stored_retention": _raw_select(
            'event_id, epoch_us("timestamp") as "timestamp", year("timestamp")::int as year, '
            'month("timestamp")::int as month, day("timestamp")::int as day, hour("timestamp")::int as hour',
            real_time=True,
        )
        + " where \"timestamp\" >= timestamp '2024-04-14 12:00:00' - interval 90 day",
        "zscore_outliers": ZSCORES,
        "seasonal_residual": SEASONAL,
        "asset_join": f"""with raw as ({_raw()}), asset as ({ASSETS})
            select event_id, raw.source_ip, owner, segment from raw left join asset on raw.source_ip = asset.source_ip""",
        "geo_join": GEO,
        "threat_flag": f"""with raw as ({_raw()}), listed as ({THREATS})
            select event_id, source_ip, destination_ip, (s.ip is not null or d.ip is not null) as is_threat
            from raw left join listed s on source_ip = s.ip left join listed d on destination_ip = d.ip""",
        "ip_masking": _raw_select(
            f"event_id, {_masked('source_ip')} as source_ip, {_masked('destination_ip')} as destination_ip, "
            f"sha256('{Q.SALT}' || source_ip) as source_hash, sha256('{Q.SALT}' || destination_ip) as destination_hash"
        ),
        "pii_flags": r"""select doc_id,
            coalesce(regexp_matches(text, '[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]{1,255}\.[A-Za-z]{2,}'), false) as has_email,
            coalesce(regexp_matches(text,
                '(^|[^0-9])(\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}([^0-9]|$)'), false) as has_phone,
            coalesce(regexp_matches(text,
                '(^|[^0-9])[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}([^0-9]|$)'), false) as has_card
            from documents""",
        "stream_metrics": f"{METRICS} {_DERIVED} where {_CLOSED.format(120000000, 'log')}",
        "stream_late": f"{LATE_METRICS} {_DERIVED} where {_CLOSED.format(120000000, 'log')}",
        "stream_alerts": ALERTS,
        "stream_open_windows": f"{LATE_METRICS} {_DERIVED} where {_CLOSED.format(120000000, 'log')}",
        "stream_simple": f"""{_simple("log")} select * from metric where (log_count > 1000 or avg_response_time > 5000)
            and {_CLOSED.format(30000000, 'log')}""",
        "stream_records": _result_records(_CLOSED.format(120000000, "log")),
        "stream_counters": f"""{METRICS}, found as (select count(*) as n from alert
            where {_CLOSED.format(120000000, 'log')})
            select (select count(*) from log) as logs_processed, (select n from found) as anomalies_detected,
            (select n from found) as alerts_sent""",
        "declared_levels": f"""{METRICS} select window_start, window_end, {KEYS}, anomaly_score,
            case when anomaly_score > 0.8::double then 'CRITICAL' when anomaly_score > 0.7::double then 'HIGH'
                 when anomaly_score > 0.5::double then 'MEDIUM' else 'LOW' end as anomaly_level from anomaly""",
        "null_default": f"{LOG} select event_id, {_FLAT_LOG} from log",
        "schema_check": """select unnest(['bytes_sent: string instead of bigint', 'hostname: absent']) as problem,
            count(*) as n_rows from events""",
        "isolation_forest": _forest(100, 256),
        "isolation_forest_few": _forest(Q.FEW_TREES, Q.FEW_SAMPLE),
        "compacted_store": _raw_select(
            'event_id, epoch_us("timestamp") as "timestamp", year("timestamp")::int as year, '
            'month("timestamp")::int as month, day("timestamp")::int as day, hour("timestamp")::int as hour',
            real_time=True,
        ),
        "latency_histogram": f"""{LOG}, edge as (select unnest([0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0,
                10.0, 30.0, 60.0])::double as edge),
            bucket as (select row_number() over (order by edge) - 1 as bucket, lag(edge) over (order by edge) as over_seconds,
                edge as upto_seconds from edge union all select count(*), max(edge), null from edge),
            counted as (select traffic_direction, bucket::int as bucket, over_seconds, upto_seconds,
                count(*) filter (where (over_seconds is null or response_time_ms / 1000 > over_seconds)
                    and (upto_seconds is null or response_time_ms / 1000 <= upto_seconds)) as n
                from log, bucket group by 1, 2, 3, 4)
            select *, (sum(n) over (partition by traffic_direction order by bucket))::bigint as n_upto from counted""",
        "seasonal_calendar": SEASONAL_CALENDAR,
    }
