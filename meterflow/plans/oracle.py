"""The same queries as DuckDB SQL, stated naively over the typed columns."""

from __future__ import annotations

from meterflow.functions import path_normaliser
from meterflow.plans.demo_model import DEMO_MODEL, DEMO_TOTAL_SQL
from meterflow.plans.derive import catalogue_sql, hierarchy_sql, typed_sql

_PAD = "concat(' ', chr(9))"


def _text(us: str, pattern: str = "%Y-%m-%d %H:%M:%S") -> str:
    return f"strftime(make_timestamp({us}), '{pattern}')"


_BASE = f"""
with recursive typed as ({typed_sql("duckdb")}),
catalogue as ({catalogue_sql()}),
hierarchy as ({hierarchy_sql()}),
parsed as (
  select *, trim(msn, {_PAD}) as msn_t,
    case when not text_numbers then v_r end as v_r_num,
    case when not text_numbers then v_y end as v_y_num, v_b as v_b_num
  from typed where shape = 'object'),
validated as (
  select *, case when coalesce(msn_t, '') = '' then 'INVALID' else 'VALID' end as validation_status,
    case when coalesce(msn_t, '') = '' then 'MSN is null or blank' end as validation_reason
  from parsed),
cat as (select * from catalogue
  qualify row_number() over (partition by event_id order by ordinal desc) = 1),
net as (
  select substation_name, feeder_name, dtr_name, dtr_network_code, key as msn_normalized
  from (select *, upper(trim(msn_normalized, {_PAD})) as key from hierarchy) where key <> ''
  qualify row_number() over (partition by key order by ordinal desc) = 1),
enriched as (
  select v.*, c.event_id is not null as event_catalogue_match, c.event_tblrefid, c.event_name,
    c.event_description, c.event_state, c.isrestoration, c.priorityname,
    c.eventclassification_name, n.msn_normalized is not null as hierarchy_match,
    n.msn_normalized, n.dtr_name, n.dtr_network_code, n.feeder_name, n.substation_name
  from validated v left join cat c on v.evnt_id = c.event_id
  left join net n on nullif(upper(v.msn_t), '') = n.msn_normalized)
"""

_FEATURES = f"""
, feature_rows as (
  select msn_t as msn, us, us // 900000000 * 900000000 as w, v_r_num, v_y_num, v_b_num,
    event_name = 'Power failure' and event_state = 'OCCURRENCE' as failure
  from enriched where validation_status = 'VALID' and us is not null),
features as (
  select msn, w, count(*) as event_count_15m,
    (coalesce(sum(v_r_num), 0) + coalesce(sum(v_y_num), 0) + coalesce(sum(v_b_num), 0))
      / nullif(count(v_r_num) + count(v_y_num) + count(v_b_num), 0) as avg_voltage_15m,
    greatest(max(v_r_num), max(v_y_num), max(v_b_num))
      - least(min(v_r_num), min(v_y_num), min(v_b_num)) as voltage_range_15m,
    count(*) filter (where failure) as power_failure_count_15m
  from feature_rows group by msn, w)
"""

_SCORED = _BASE + _FEATURES + f"""
, scored as (
  select *, case when avg_voltage_15m is not null and voltage_range_15m is not null
    then -pow(2.0::double, -({DEMO_TOTAL_SQL}) / (3 * {path_normaliser(256)!r}::double))
      - ({DEMO_MODEL.offset}::double) end as decision from features),
labelled as (
  select msn, {_text("w")} as window_start, {_text("w + 900000000")} as window_end,
    event_count_15m, avg_voltage_15m, voltage_range_15m, power_failure_count_15m,
    round(decision, 9) as decision, round(-decision, 9) as anomaly_score,
    case when decision < 0 then -1 when decision is not null then 1 end as prediction,
    case when decision < 0 then 'ANOMALY' when decision is not null then 'NORMAL' end
      as anomaly_label from scored)
"""

_SCORES = "msn, window_start, event_count_15m, decision, anomaly_score, prediction, anomaly_label"

_OUTAGE_ROWS = """
, outage_rows as (
  select msn_t as msn, event_tblrefid, seq, event_state = 'OCCURRENCE' as occurs, us,
    event_name, dtr_name, dtr_network_code, feeder_name, substation_name
  from enriched
  where event_name = 'Power failure' and event_state in ('OCCURRENCE', 'RESTORATION')
    and coalesce(msn_t, '') <> '' and us is not null)
"""


def _machine(key: str, start: str, guard: str) -> str:
    """Step every key through its rows in arrival order; one recursion level per row."""
    return f"""
, numbered as (
  select *, {key} as meter, {start} as start_us,
    row_number() over (partition by {key}, event_tblrefid order by seq) as rn
  from outage_rows),
machine as (
  select meter, event_tblrefid, rn, case when occurs then start_us end as open_us,
    case when occurs then rn end as open_rn, null::bigint as closed_rn, null::bigint as end_us
  from numbered where rn = 1
  union all
  select n.meter, n.event_tblrefid, n.rn,
    case when m.open_rn is null and n.occurs then n.start_us
         when m.open_rn is not null and not n.occurs and {guard} then null else m.open_us end,
    case when m.open_rn is null and n.occurs then n.rn
         when m.open_rn is not null and not n.occurs and {guard} then null else m.open_rn end,
    case when m.open_rn is not null and not n.occurs and {guard} then m.open_rn end,
    case when m.open_rn is not null and not n.occurs and {guard} then n.us end
  from machine m join numbered n
    on n.meter = m.meter and n.event_tblrefid = m.event_tblrefid and n.rn = m.rn + 1),
last_rn as (select meter, event_tblrefid, max(rn) as rn from machine group by 1, 2),
incident_rows as (
  select meter, event_tblrefid, closed_rn as rn, end_us from machine where closed_rn is not null
  union all
  select m.meter, m.event_tblrefid, m.open_rn, null
  from machine m join last_rn l using (meter, event_tblrefid, rn) where m.open_rn is not null),
incidents as (
  select n.meter as msn, n.event_tblrefid, n.start_us, i.end_us, n.event_name, n.dtr_name,
    n.dtr_network_code, n.feeder_name, n.substation_name
  from incident_rows i join numbered n using (meter, event_tblrefid, rn))
"""


_JOB_MACHINE = _machine("msn", "us // 1000000 * 1000000", "n.us >= m.open_us")
_SERVICE_MACHINE = _machine("upper(msn)", "us", "true")

_LOG = f"""
, log as (
  select concat(msn, ':', event_tblrefid, ':', {_text("start_us", "%Y-%m-%dT%H:%M:%S")})
      as incident_id, msn, event_name, event_tblrefid, s.status as incident_status,
    {_text("start_us")} as start_ts,
    case when s.status = 'CLOSED' then {_text("end_us")} end as end_ts,
    case s.status when 'UNRESOLVED' then 5.0::double
      when 'CLOSED' then ((end_us - start_us) // 1000)::double / 60000.0::double end
      as duration_minutes,
    dtr_name, dtr_network_code, feeder_name, substation_name
  from incidents, (values ('OPEN'), ('UNRESOLVED'), ('CLOSED')) as s(status)
  where s.status = 'OPEN' or (s.status = 'CLOSED' and end_us is not null)
    or (s.status = 'UNRESOLVED' and (end_us is null or end_us - start_us > 300000000)))
"""

_LOG_COLUMNS = """incident_id, msn, event_name, event_tblrefid, incident_status, start_ts, end_ts,
  round(duration_minutes, 6) as duration_minutes, dtr_name, dtr_network_code, feeder_name,
  substation_name"""

_JOB_LOG = _BASE + _OUTAGE_ROWS + _JOB_MACHINE + _LOG

_MINUTES = "sum(round(duration_minutes * 60000)::bigint)::double / 60000.0::double"

_LEVELS = """
, levelled as (
  select log.*, l.level,
    case l.level when 'meter' then msn when 'transformer' then dtr_name
      when 'feeder' then feeder_name when 'substation' then substation_name
      else substring(start_ts, 1, 10) end as name
  from log, (values ('meter'), ('transformer'), ('feeder'), ('substation'), ('day')) as l(level))
"""

_TOPOLOGY = """
, occurred as (
  select * from enriched
  where event_name = 'Power failure' and event_state = 'OCCURRENCE'
    and coalesce(msn_t, '') <> '' and us is not null and not padded_ts),
known as (
  select * from occurred where hierarchy_match and feeder_name is not null
    and latitude is not null and longitude is not null),
unknown as (
  select * from occurred where not hierarchy_match
    and latitude is not null and longitude is not null),
pairs as (
  select u.seq, u.msn, u.ts, u.us, u.latitude as ulat, u.longitude as ulon, k.feeder_name,
    k.substation_name, k.msn as kmsn, k.us as kus, k.seq as kseq, k.latitude as klat,
    k.longitude as klon
  from unknown u join known k on k.us between u.us - 300000000 and u.us
    and (k.us < u.us or k.seq < u.seq)),
meters as (
  select * from pairs
  qualify row_number() over (partition by seq, feeder_name, kmsn order by kus, kseq) = 1),
feeders as (
  select seq, msn, ts, us, ulat, ulon, feeder_name, count(*) as n, avg(klat) as centroid_lat,
    avg(klon) as centroid_lon, arg_min(coalesce(substation_name, ''), kus::hugeint * 1000000000 + kseq) as substation,
    min(kus::hugeint * 1000000000 + kseq) as first
  from meters group by all),
distances as (
  select *, n / max(n) over (partition by seq)::double as cooccurrence,
    2 * 6371.0088 * atan2(sqrt(chord), sqrt(1 - chord)) as distance
  from (select *, pow(sin(radians(centroid_lat - ulat) / 2), 2)
      + cos(radians(ulat)) * cos(radians(centroid_lat))
        * pow(sin(radians(centroid_lon - ulon) / 2), 2) as chord from feeders)),
scored as (
  select *, greatest(0.0::double, 1.0::double - distance / 20.0::double) as proximity,
    0.7::double * cooccurrence
      + 0.3::double * greatest(0.0::double, 1.0::double - distance / 20.0::double) as score
  from distances),
ranked as (
  select *, cast(row_number() over (
    partition by seq order by score desc, n desc, first) as integer)
    as candidate_rank
  from scored)
"""

_ISO = f"""case when us % 60000000 = 0 then {_text("us", "%Y-%m-%dT%H:%M")}
    when us % 1000000 = 0 then {_text("us", "%Y-%m-%dT%H:%M:%S")}
    when us % 1000 = 0 then {_text("us", "%Y-%m-%dT%H:%M:%S.%g")}
    else {_text("us", "%Y-%m-%dT%H:%M:%S.%f")} end"""


def _round4(value: str) -> str:
    return f"floor({value} * 10000.0::double + 0.5::double) / 10000.0::double"


def _fractional(us: str, separator: str = " ") -> str:
    whole = _text(us, f"%Y-%m-%d{separator}%H:%M:%S")
    return f"case when {us} % 1000000 = 0 then {whole} else " \
           f"{_text(us, f'%Y-%m-%d{separator}%H:%M:%S.%f')} end"


_CATALOGUE = "event_tblrefid, event_name, event_state, isrestoration, priorityname, " \
             "eventclassification_name"
_NETWORK = "dtr_name, dtr_network_code, feeder_name, substation_name"

ORACLES: dict[str, str] = {
    "parse_events": _BASE + """
select seq, msn, msn_id, evnt_id, ts, log_seq_no, v_r, v_y, v_b, v_r_num, v_y_num, v_b_num, dt,
  latitude, longitude, us as event_us from parsed""",
    "parse_events_sql": _BASE + """
select seq, case when shape = 'object' then msn end as msn,
  case when shape = 'object' then msn_id end as msn_id,
  case when shape = 'object' then evnt_id end as evnt_id,
  case when shape = 'object' then ts end as event_ts,
  case when shape = 'object' then log_seq_no end as log_seq_no,
  case when shape = 'object' then v_r end as v_r, case when shape = 'object' then v_y end as v_y,
  case when shape = 'object' then v_b end as v_b from typed""",
    "quarantine_events": _BASE + """
select seq, case shape when 'malformed' then 'MALFORMED' else 'NOT_AN_OBJECT' end as reject_reason
from typed where shape <> 'object'""",
    "validate_events": _BASE + """
select seq, msn, validation_status, validation_reason from validated""",
    "validate_events_sqlcodes": _BASE + """
select seq, case when shape = 'object' then msn end as msn,
  case when shape = 'object' and trim(msn) <> '' then 'PASS' else 'FAIL' end as validation_status,
  case when shape = 'object' and trim(msn) <> '' then null else 'MISSING_MSN' end
    as validation_reason from typed""",
    "enrich_catalogue": _BASE + f"""
select seq, evnt_id, event_catalogue_match, {_CATALOGUE} from enriched""",
    "enrich_hierarchy": _BASE + f"""
select seq, msn, hierarchy_match, msn_normalized, {_NETWORK} from enriched""",
    "hierarchy_lookup": _BASE + f"select msn_normalized, {_NETWORK} from net",
    "enriched_events": _BASE + f"""
select seq, msn, evnt_id, ts, latitude, longitude, event_catalogue_match, {_CATALOGUE},
  hierarchy_match, msn_normalized, {_NETWORK}, validation_status from enriched""",
    "enriched_sql_variant": _BASE + f"""
, p as (
  select case when shape = 'object' then msn end as msn,
    case when shape = 'object' then msn_id end as msn_id,
    case when shape = 'object' then evnt_id end as evnt_id,
    case when shape = 'object' then ts end as event_ts,
    case when shape = 'object' then log_seq_no end as log_seq_no,
    case when shape = 'object' then v_r end as v_r, case when shape = 'object' then v_y end as v_y,
    case when shape = 'object' then v_b end as v_b,
    case when shape = 'object' and trim(msn) <> '' then 'PASS' else 'FAIL' end as validation_status,
    case when shape = 'object' and trim(msn) <> '' then null else 'MISSING_MSN' end
      as validation_reason
  from typed)
select p.*, c.event_name, c.event_description, c.event_tblrefid, c.event_state, c.priorityname,
  c.eventclassification_name, h.dtr_name, h.dtr_network_code, h.feeder_name, h.substation_name
from p left join catalogue c on p.evnt_id = c.event_id
left join hierarchy h on upper(trim(p.msn)) = upper(trim(h.msn_normalized))""",
    "enriched_service_variant": _BASE + f"""
select seq, msn, msn_id, evnt_id, log_seq_no, v_r, v_y, v_b, validation_status,
  validation_reason, event_name, event_description, event_tblrefid, event_state, priorityname,
  eventclassification_name, {_NETWORK} from enriched""",
    "processed_events": _BASE + f"""
select msn, msn_id, evnt_id, ts as event_ts, log_seq_no, v_r, v_y, v_b, validation_status,
  validation_reason, event_catalogue_match, {_CATALOGUE}, hierarchy_match, msn_normalized,
  {_NETWORK} from enriched""",
    "processed_events_narrow": _BASE + """
select msn, msn_id, evnt_id, ts as event_ts, log_seq_no, v_r, v_y, v_b, validation_status,
  validation_reason from validated""",
    "feature_eligible": _BASE + """
select seq, msn, us as event_us from validated
where validation_status = 'VALID' and us is not null""",
    "meter_features_15m": _BASE + _FEATURES + f"""
select msn, {_text("w")} as window_start, {_text("w + 900000000")} as window_end,
  event_count_15m, round(avg_voltage_15m, 7) as avg_voltage_15m,
  round(voltage_range_15m, 7) as voltage_range_15m, power_failure_count_15m from features""",
    "outage_events": _BASE + _OUTAGE_ROWS + """
select msn, event_tblrefid, seq, occurs, us as event_us from outage_rows""",
    "outage_previous_state": _BASE + _OUTAGE_ROWS + """
select msn, event_tblrefid, seq, occurs, lag(occurs) over (
  partition by msn, event_tblrefid order by seq) as previous_occurs
from outage_rows""",
    "outage_incidents": _JOB_LOG + f"""
select {_LOG_COLUMNS} from log where incident_status <> 'UNRESOLVED'""",
    "outage_unresolved_event_time": _JOB_LOG + f"""
select {_LOG_COLUMNS} from log where incident_status = 'UNRESOLVED'""",
    "outage_service_variant": _BASE + _OUTAGE_ROWS + _SERVICE_MACHINE + f"""
select concat(msn, ':', event_tblrefid, ':', {_fractional("start_us", "T")}) as incident_id, msn,
  event_name, event_tblrefid, s.status as incident_status, {_fractional("start_us")} as start_ts,
  case when s.status = 'CLOSED' then {_fractional("end_us")} end as end_ts,
  case when s.status = 'CLOSED' then round_even((end_us - start_us)::double / 60000000.0::double, 2)
    end as duration_minutes, {_NETWORK}
from incidents, (values ('OPEN'), ('CLOSED')) as s(status)
where s.status = 'OPEN' or end_us is not null""",
    "outage_rejects": _BASE + """
select seq, event_state, case when coalesce(msn_t, '') = '' then 'MISSING_MSN'
  when event_tblrefid is null then 'MISSING_PAIR_ID'
  when us is null then 'INVALID_TIMESTAMP' end as reject_reason
from enriched where event_name = 'Power failure'""",
    "incident_latest": _JOB_LOG + f"""
select {_LOG_COLUMNS} from log qualify row_number() over (
  partition by incident_id order by case incident_status when 'OPEN' then 0
    when 'UNRESOLVED' then 1 else 2 end desc, coalesce(end_ts, '') desc) = 1""",
    "active_incidents": _JOB_LOG + """
select incident_id, msn, start_ts, feeder_name, substation_name from log
where incident_status = 'OPEN'
  and incident_id not in (select incident_id from log where incident_status = 'CLOSED')""",
    "outage_frequency": _JOB_LOG + _LEVELS + """
select level, name, count(*) as outages from levelled where incident_status = 'OPEN'
group by level, name""",
    "restoration_activity": _JOB_LOG + _LEVELS + """
select level, name, count(*) filter (where incident_status = 'OPEN') as opened,
  count(*) filter (where incident_status = 'UNRESOLVED') as unresolved,
  count(*) filter (where incident_status = 'CLOSED') as closed,
  round(count(*) filter (where incident_status = 'CLOSED')
    / nullif(count(*) filter (where incident_status = 'OPEN'), 0)::double, 6) as share_closed
from levelled group by level, name""",
    "outage_duration": _JOB_LOG + _LEVELS + f"""
select level, name, count(*) as closed,
  {_MINUTES} as total_minutes, {_MINUTES} / count(*)::double as mean_minutes,
  round(max(duration_minutes), 6) as max_minutes,
  round(quantile_cont(duration_minutes, 0.5), 6) as median_minutes
from levelled where incident_status = 'CLOSED' group by level, name""",
    "reliability_rollup": _JOB_LOG + f"""
select substation_name, feeder_name, dtr_name, count(*) as outages,
  {_MINUTES} as total_minutes, {_MINUTES} / count(*)::double as mean_minutes,
  cast(3 - bit_count(grouping(substation_name, feeder_name, dtr_name)) as integer) as depth
from log where incident_status = 'CLOSED'
group by rollup (substation_name, feeder_name, dtr_name)""",
    "topology_evidence": _BASE + _TOPOLOGY + """
select seq, msn, 'known' as side from known
union all select seq, msn, 'unknown' from unknown""",
    "topology_candidates": _BASE + _TOPOLOGY + """
select seq, msn, feeder_name, nullif(substation, '') as substation_name, n,
  cast(first % 1000000000 as bigint) as first_seq, round(centroid_lat, 6) as centroid_lat,
  round(centroid_lon, 6) as centroid_lon, round(distance, 6) as distance,
  round(cooccurrence, 6) as cooccurrence, round(proximity, 6) as proximity,
  round(score, 6) as score, candidate_rank from ranked""",
    "topology_top3": _BASE + _TOPOLOGY + f"""
select concat(msn, ':', {_ISO}) as inference_id, 'topology-inference' as use_case,
  msn as unknown_msn, ts as event_ts, candidate_rank, feeder_name as candidate_feeder,
  substation as candidate_substation, n as supporting_meter_count,
  {_round4("cooccurrence")} as cooccurrence_score, {_round4("distance")} as distance_km,
  {_round4("proximity")} as proximity_score, {_round4("score")} as topology_score,
  feeder_name as prediction, {_round4("score")} as confidence, 'INFO' as severity,
  case when candidate_rank = 1
    then 'Highest combined outage co-occurrence and geographic proximity score.'
    else 'Alternative candidate based on recent outage and geographic evidence.' end as reason,
  case when candidate_rank = 1
    then concat('Review feeder ', feeder_name, ' as the likely topology assignment.')
    else 'Retain as an alternative feeder candidate.' end as recommendation
from ranked where candidate_rank <= 3""",
    "haversine_distance": _BASE + """
select seq, round(km, 6) as km,
  case when km is not null
    then round(greatest(0.0::double, 1.0::double - km / 20.0::double), 6) end as proximity
from (select seq, 2 * 6371.0088 * atan2(sqrt(chord), sqrt(1 - chord)) as km
  from (select seq, pow(sin(radians(28.2 - latitude) / 2), 2)
      + cos(radians(latitude)) * cos(radians(28.2)) * pow(sin(radians(77.2 - longitude) / 2), 2)
      as chord from parsed))""",
    "replay_order": _BASE + """
select seq, dt, case when dt is null then us
  else epoch_us(strptime(dt, '%Y%m%d%H%M')) end as replay_us from parsed""",
}
ORACLES |= {
    "anomaly_scores_pandas": _SCORED + f"select {_SCORES} from labelled",
    "anomaly_scores_hof": _SCORED + f"select {_SCORES} from labelled",
    "anomaly_results": _SCORED + """
select msn, window_start, window_end, event_count_15m, round(avg_voltage_15m, 7) as avg_voltage_15m,
  round(voltage_range_15m, 7) as voltage_range_15m, power_failure_count_15m,
  'anomaly-detection' as use_case, 'IsolationForest' as model_type, '' as sklearn_version,
  0.1::double as model_contamination, coalesce(anomaly_label, 'UNSCORABLE') as prediction,
  null::double as confidence, anomaly_score,
  case anomaly_label when 'ANOMALY' then 'WARNING' when 'NORMAL' then 'NORMAL' else 'UNKNOWN' end
    as severity,
  case anomaly_label
    when 'ANOMALY' then 'Unusual combination of 15-minute meter features relative to the learned training distribution.'
    when 'NORMAL' then '15-minute meter feature combination falls within the learned operating distribution.'
    else 'Required Isolation Forest feature values are missing.' end as reason,
  case anomaly_label
    when 'ANOMALY' then 'Review the source events and phase-voltage readings for this meter and time window.'
    when 'NORMAL' then 'No anomaly-specific action required.'
    else 'Review feature completeness before anomaly assessment.' end as recommendation
from labelled""",
    "anomaly_rank": _SCORED + f"""
select {_SCORES}, row_number() over (order by anomaly_score desc, msn, window_start) as anomaly_rank
from labelled where anomaly_score is not null""",
    "anomaly_top10": _SCORED + f"""
select {_SCORES} from labelled order by anomaly_score desc nulls last, msn, window_start limit 10""",
    "lowest_decisions": _SCORED + f"""
select {_SCORES} from labelled order by decision asc nulls last, msn, window_start limit 6""",
    "anomaly_count": _SCORED + """
select count(*) as rows, count(*) filter (where anomaly_label = 'ANOMALY') as anomalies
from labelled""",
    "feature_profile": _BASE + _FEATURES + """
select rows, meters, f.feature, f.missing, f.distinct_values, f.distinct_values > 1 as varies
from (select count(*) as rows, count(distinct msn) as meters, unnest([
    {'feature': 'event_count_15m', 'missing': count(*) - count(event_count_15m),
     'distinct_values': count(distinct event_count_15m)},
    {'feature': 'avg_voltage_15m', 'missing': count(*) - count(avg_voltage_15m),
     'distinct_values': count(distinct round(avg_voltage_15m, 7))},
    {'feature': 'voltage_range_15m', 'missing': count(*) - count(voltage_range_15m),
     'distinct_values': count(distinct round(voltage_range_15m, 7))},
    {'feature': 'power_failure_count_15m', 'missing': count(*) - count(power_failure_count_15m),
     'distinct_values': count(distinct power_failure_count_15m)}]) as f from features)""",
    "score_quantile": _SCORED + """
select round(quantile_cont(decision, 0.1), 9) as quantile from labelled""",
    "scorer_parity": _SCORED + """
select count(*) as rows, count(*) as matching_predictions, 0::bigint as mismatching_predictions,
  'STRICT' as verdict, 0.0::double as max_difference, 0.0::double as mean_difference
from labelled""",
    "iforest_train_summary": _BASE + _FEATURES + """
select 200::integer as trees, least(256, count(*) filter (where avg_voltage_15m is not null
    and voltage_range_15m is not null))::integer as max_samples,
  concat_ws(',',
    case when min(event_count_15m) < max(event_count_15m) then 'event_count_15m' end,
    case when min(avg_voltage_15m) < max(avg_voltage_15m) then 'avg_voltage_15m' end,
    case when min(voltage_range_15m) < max(voltage_range_15m) then 'voltage_range_15m' end,
    case when min(power_failure_count_15m) < max(power_failure_count_15m)
      then 'power_failure_count_15m' end) as features,
  count(*) as rows, 0.1::double as flagged_share from features""",
}
ORACLES["scorer_parity_trained"] = ORACLES["scorer_parity"]
ORACLES["processed_json"] = ORACLES["processed_events_narrow"]
ORACLES["outage_incidents_chunked"] = ORACLES["outage_incidents"]
ORACLES["outage_previous_state_chunked"] = ORACLES["outage_previous_state"]

# A stream emits a window once the latest event, less five seconds, has reached its end.
def _emitted_windows(sql: str) -> str:
    return f"""
select * exclude (window_us) from (
  select *, epoch_us(window_end::timestamp) as window_us from ({sql}))
where window_us <= (select max(us) // 1000 * 1000 - 5000000 from (
  {_BASE + _FEATURES} select us from feature_rows))"""


ORACLES |= {
    "stream_processed_events": ORACLES["processed_events"],
    "stream_meter_features": _emitted_windows(ORACLES["meter_features_15m"]),
    "stream_anomalies": _emitted_windows(ORACLES["anomaly_results"]),
    "stream_outages": ORACLES["outage_incidents"],
    "stream_service_outages": ORACLES["outage_service_variant"],
    "stream_unresolved": _JOB_LOG + f"""
select {_LOG_COLUMNS} from log where incident_status = 'UNRESOLVED'""",
    "stream_reliability": ORACLES["reliability_rollup"],
    "stream_restoration": ORACLES["restoration_activity"],
    "stream_current_status": ORACLES["incident_latest"],
    "stream_topology": ORACLES["topology_top3"],
    "stored_features": ORACLES["meter_features_15m"],
}
ORACLES |= {
    "features_json": ORACLES["meter_features_15m"],
    "anomalies_json": ORACLES["anomaly_results"],
    "catalogue_csv": ORACLES["enrich_catalogue"],
    "hierarchy_csv": ORACLES["hierarchy_lookup"],
    "hierarchy_csv_positional": ORACLES["hierarchy_lookup"],
    "events_jsonl": f"select * exclude (seq) from ({ORACLES['parse_events']})",
    "training_csv": f"select * exclude (window_end) from ({ORACLES['meter_features_15m']})",
    "scored_csv": ORACLES["anomaly_scores_pandas"],
    "model_file_scores": ORACLES["anomaly_scores_pandas"],
    "arrival_stamps": _BASE + _FEATURES + "select count(*) as rows, count(*) as stamped from features",
    "stream_enriched": ORACLES["enriched_events"],
    "stream_quarantine": ORACLES["quarantine_events"],
}
