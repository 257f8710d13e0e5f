"""Meter tables derived from the generic ``events`` and ``customer`` tables.

One event row becomes one raw meter message; one customer row becomes one network-hierarchy row.
The typed columns are stated once, as SQL both Spark and DuckDB accept, so that an oracle can
start from the typed values while Spark starts from the JSON text it has to parse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterflow.session import prepare, scratch_path

EPOCH_US = 1704067200000000  # 2024-01-01; the 30 days of events are squeezed into one day.

ROW_GROUP_BYTES = 2 << 20

_DIALECTS = {
    "spark": {
        "us": "unix_micros(cast(ts as timestamp))",
        "div": "div",
        "text": "date_format(timestamp_micros(eus), 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
        "minute": "date_format(timestamp_micros(eus), 'yyyyMMddHHmm')",
        "tab": r"'\t'",
    },
    "duckdb": {
        "us": "epoch_us(ts)",
        "div": "//",
        "text": "strftime(make_timestamp(eus), '%Y-%m-%d %H:%M:%S.%f')",
        "minute": "strftime(make_timestamp(eus), '%Y%m%d%H%M')",
        "tab": "chr(9)",
    },
}

_TYPED = """
select
  event_id as seq,
  user_id,
  case when event_id % 97 = 13 then 'malformed' when event_id % 101 = 17 then 'array'
       else 'object' end as shape,
  case when user_id % 17 <> 0 then concat(' sm', lpad(cast(user_id as varchar(20)), 6, '0'), ' ')
       when event_id % 3 = 0 then null when event_id % 3 = 1 then '  ' else {tab} end as msn,
  user_id + 100000 as msn_id,
  case when event_id % 89 = 5 then null when event_type = 'error' then 101
       when event_type = 'signup' then 102 when event_type = 'click' then 201
       when event_type = 'view' then 202 else 999 end as evnt_id,
  case when event_id % 211 = 5 then '2024-13-45 00:00:00'
       when event_id % 223 = 7 then concat(' ', {text}, ' ')
       when event_id % 4 = 0 then substring({text}, 1, 19) else {text} end as ts,
  case when event_id % 211 = 5 then null
       when event_id % 223 = 7 then eus
       when event_id % 4 = 0 then eus {div} 1000000 * 1000000 else eus end as us,
  event_id % 223 = 7 as padded_ts,
  event_id * 2 as log_seq_no,
  case when event_id % 3 <> 0 then {minute} end as dt,
  case when event_id % 7 <> 0 then cast(230 as double) + value / cast(20 as double) end as v_r,
  case when event_id % 9 <> 0 then cast(228 as double) + value / cast(25 as double) end as v_y,
  case when event_id % 63 <> 0 then cast(232 as double) + value / cast(30 as double) end as v_b,
  event_id % 11 = 0 as text_numbers,
  case when user_id % 23 <> 0 then cast(28 as double)
       + cast((user_id * 37) % 401 * 10 + event_id % 3 as double) / cast(10000 as double)
       end as latitude,
  case when user_id % 23 <> 0 then cast(77 as double)
       + cast((user_id * 53) % 401 * 10 + event_id % 2 as double) / cast(10000 as double)
       end as longitude
from (
  select *, {epoch} + ({us} - {epoch}) {div} 30
    - case when event_id % 37 = 3 then 600000000 else 0 end as eus
  from {events}
) shifted
"""

_HIERARCHY = """
select 1 as ordinal,
  case when c_custkey % 29 <> 3 then concat('SS', cast(c_custkey % 4 as varchar(20))) end
    as substation_name,
  case when c_custkey % 31 <> 4 then concat('FD', cast(c_custkey % 12 as varchar(20))) end
    as feeder_name,
  concat('DT', cast(c_custkey % 60 as varchar(20))) as dtr_name,
  concat('DTC', cast(c_custkey % 60 as varchar(20))) as dtr_network_code,
  concat('sm', lpad(cast(c_custkey as varchar(20)), 6, '0')) as msn,
  case when c_custkey % 41 = 7 then ' '
       else concat(' Sm', lpad(cast(c_custkey as varchar(20)), 6, '0')) end as msn_normalized
from {customer} where c_custkey % 5 <> 0
union all
select 0, 'OLD', 'OLD', 'OLD', 'OLD', 'old',
  concat('sm', lpad(cast(c_custkey as varchar(20)), 6, '0'))
from {customer} where c_custkey % 10 = 1
"""

# event_id, event_tblrefid, event_name, event_description, event_state, isrestoration,
# priorityname, eventclassification_name; the second 201 row must win over the first.
_CATALOGUE = """
select * from (values
  (0, 101, 1, 'Power failure', 'Supply lost', 'OCCURRENCE', false, 'High', 'Supply'),
  (1, 102, 1, 'Power failure', 'Supply back', 'RESTORATION', true, 'High', 'Supply'),
  (2, 201, 9, 'Superseded', 'Superseded', 'OCCURRENCE', false, 'Low', 'None'),
  (3, 201, 2, 'Voltage low', 'Under-voltage', 'OCCURRENCE', false, 'Medium', 'Voltage'),
  (4, 202, 2, 'Voltage low', 'Voltage normal', 'RESTORATION', true, 'Medium', 'Voltage')
) as c(ordinal, event_id, event_tblrefid, event_name, event_description, event_state,
       isrestoration, priorityname, eventclassification_name)
"""


def typed_sql(dialect: str, events: str = "events") -> str:
    return _TYPED.format(epoch=EPOCH_US, events=events, **_DIALECTS[dialect])


def hierarchy_sql(customer: str = "customer") -> str:
    return _HIERARCHY.format(customer=customer)


def catalogue_sql() -> str:
    return _CATALOGUE


def _json_pair(field: str, text: F.Column, quoted: F.Column | None = None) -> F.Column:
    plain = F.concat(F.lit(f'"{field}":'), text)
    if quoted is None:
        return plain
    return F.when(quoted, F.concat(F.lit(f'"{field}":"'), text, F.lit('"'))).otherwise(plain)


def as_messages(typed: DataFrame) -> DataFrame:
    """Typed rows as ``(seq, payload)`` messages, with the malformed ones left broken."""
    def number(name: str) -> F.Column:
        return F.col(name).cast("string")

    def text(name: str) -> F.Column:
        return F.concat(F.lit('"'), F.replace(F.col(name), F.lit("\t"), F.lit("\\t")), F.lit('"'))

    quoted = F.col("text_numbers")
    body = F.concat_ws(
        ",",
        F.coalesce(_json_pair("msn", text("msn")), F.lit('"msn":null')),
        _json_pair("msn_id", number("msn_id")),
        _json_pair("evnt_id", number("evnt_id"), F.col("seq") % 13 == 0),
        _json_pair("ts", text("ts")),
        _json_pair("log_seq_no", number("log_seq_no")),
        F.coalesce(_json_pair("v_r", number("v_r"), quoted), F.lit('"v_r":null')),
        _json_pair("v_y", number("v_y"), quoted),
        _json_pair("v_b", number("v_b")),
        _json_pair("dt", text("dt")),
        _json_pair("latitude", number("latitude"), F.col("seq") % 19 == 0),
        _json_pair("longitude", number("longitude")),
    )
    payload = (
        F.when(F.col("shape") == "malformed", F.concat(F.lit("{"), body))
        .when(F.col("shape") == "array", F.lit("[1,2]"))
        .otherwise(F.concat(F.lit("{"), body, F.lit("}")))
    )
    return typed.select("seq", payload.alias("payload"))


def _typed_columns(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(typed_sql("spark", "{rows}"), rows=events)


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return as_messages(_typed_columns(spark.read.parquet(f"{sf_dir}/events.parquet")))


def event_files(spark: SparkSession, sf_dir: str, parts: int) -> str:
    """The events as files that arrive one after the other, in order of their number.

    Their row groups are small, so that the tasks of a micro-batch share its one file.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    first, last = events.agg(F.min("event_id"), F.max("event_id")).first()
    path = scratch_path(spark, "event-files")
    width = ((last or 0) - (first or 0)) // parts + 1
    for part in range(parts):
        begin = (first or 0) + part * width
        events.where(F.col("event_id").between(begin, begin + width - 1)).coalesce(1).write.mode(
            "append").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return path


def raw_message_stream(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """The same messages as a file stream: the events table, or that in ``parts`` files, a batch each."""
    prepare(spark)
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    reader = spark.readStream.schema(schema)
    if parts is None:
        stream = reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    else:
        stream = reader.option("maxFilesPerTrigger", 1).parquet(event_files(spark, sf_dir, parts))
    return as_messages(_typed_columns(stream))


def network_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return spark.sql(hierarchy_sql("{rows}"), rows=customer)


def event_catalogue(spark: SparkSession) -> DataFrame:
    return spark.sql(catalogue_sql())
