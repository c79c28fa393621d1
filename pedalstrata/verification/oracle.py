"""The registered queries in plain SQL (DuckDB dialect), over the same tables."""

from __future__ import annotations

from typing import NamedTuple


class Field(NamedTuple):
    raw: str
    silver: str
    type: str


# Stated here again, so that a wrong name or rule in the code does not agree with itself.
# Raw name, silver name and type, in silver column order.
HOUR_FIELDS = [
    Field("instant", "ride_id", "bigint"),
    Field("dteday", "ride_date", "date"),
    Field("hr", "ride_hour", "bigint"),
    Field("season", "season", "bigint"),
    Field("yr", "year_flag", "bigint"),
    Field("mnth", "month", "bigint"),
    Field("holiday", "holiday", "bigint"),
    Field("weekday", "weekday", "bigint"),
    Field("workingday", "workingday", "bigint"),
    Field("weathersit", "weather_situation", "bigint"),
    Field("temp", "temperature", "double"),
    Field("atemp", "feels_like_temperature", "double"),
    Field("hum", "humidity", "double"),
    Field("windspeed", "windspeed", "double"),
    Field("casual", "casual_users", "bigint"),
    Field("registered", "registered_users", "bigint"),
    Field("cnt", "total_rides", "bigint"),
]
DAY_FIELDS = [f for f in HOUR_FIELDS if f.raw != "hr"]
RAW_HOUR_COLUMNS = [
    "instant", "dteday", "season", "yr", "mnth", "hr", "holiday", "weekday", "workingday",
    "weathersit", "temp", "atemp", "hum", "windspeed", "casual", "registered", "cnt",
]
RAW_DAY_COLUMNS = [c for c in RAW_HOUR_COLUMNS if c != "hr"]
FEED_RULES = (
    ("season_1_4", "season", 1, 4),
    ("year_flag_0_6", "year_flag", 0, 6),
    ("month_1_12", "month", 1, 12),
    ("hour_0_11", "ride_hour", 0, 11),
    ("holiday_0_1", "holiday", 0, 1),
    ("weekday_0_6", "weekday", 0, 6),
    ("workingday_0_1", "workingday", 0, 1),
    ("weather_1_3", "weather_situation", 1, 3),
)

_CHRISTMAS = "(month(l_shipdate) = 12 and day(l_shipdate) = 25)"

_HOUR_RAW = f"""hour_raw as (
  select cast(l_orderkey * 10 + l_linenumber as varchar) as instant,
         cast(cast(l_shipdate as date) as varchar) as dteday,
         cast(quarter(l_shipdate) as int) as season,
         cast(year(l_shipdate) - 1995 as int) as yr,
         cast(month(l_shipdate) as int) as mnth,
         cast((l_orderkey * 7 + l_linenumber) % 24 as int) as hr,
         cast(case when {_CHRISTMAS} then 1 else 0 end as int) as holiday,
         cast(dayofweek(l_shipdate) as int) as weekday,
         cast(case when dayofweek(l_shipdate) between 1 and 5 and not {_CHRISTMAS}
              then 1 else 0 end as int) as workingday,
         cast(1 + l_partkey % 4 as int) as weathersit,
         l_discount * 10 as temp,
         l_tax * 10 as atemp,
         l_quantity / 50 as hum,
         cast(l_suppkey % 50 as double) / 50 as windspeed,
         cast(l_quantity as bigint) as casual,
         l_partkey % 100 as registered,
         cast(l_quantity as bigint) + l_partkey % 100 as cnt
  from lineitem)"""

_FAULTS = {
    "instant": "case when h.instant like '%7' then 'bad' else h.instant end",
    "dteday": "case when h.instant like '%6' then 'not-a-date' else h.dteday end",
    "temp": "case when h.registered % 50 = 0 then cast('NaN' as double)"
    " when h.registered % 50 = 1 then null else h.temp end",
    "cnt": "case when h.instant like '%5' then null else h.cnt end",
}


def _columns(replaced: dict[str, str], skip: tuple[str, ...] = (), table: str = "h") -> str:
    return ", ".join(f"{replaced.get(c, f'{table}.{c}')} as {c}" for c in RAW_HOUR_COLUMNS if c not in skip)


_HOUR_DIRTY = f"{_HOUR_RAW}, hour_dirty as (select {_columns(_FAULTS)} from hour_raw h)"
_MORE_FAULTS = {
    "dteday": """case right(h.instant, 1) when '0' then h.dteday || ' garbage' when '1' then h.dteday || 'Tfoo'
      when '2' then h.dteday || ' 10:20:30' when '3' then replace(h.dteday, '-', '') when '4' then null
      when '5' then '99999' || substring(h.dteday, 5) when '6' then 'not-a-date' else h.dteday end""",
    "cnt": "case h.registered % 7 when 0 then h.cnt + 1 when 1 then null else h.cnt end",
    "casual": "case when h.registered % 7 = 2 then null else h.casual end",
}
_HOUR_FAULTY = f"{_HOUR_RAW}, hour_faulty as (select {_columns(_MORE_FAULTS)} from hour_raw h)"
_DAY_DIRTY = f"{_HOUR_DIRTY}, day_dirty as (select * exclude (hr) from hour_dirty)"



def _date(c: str) -> str:
    """The date that text stands for: ISO with or without a time, or eight digits."""
    iso = r"\s*\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?\s*"
    return (
        f"case when regexp_full_match({c}, '{iso}') then try_cast(regexp_extract({c}, '\\d+-\\d+-\\d+') as date)"
        f" when regexp_full_match({c}, '\\d{{8}}') then try_cast({c}[1:4] || '-' || {c}[5:6] || '-' || {c}[7:8] as date) end"
    )


_TEMP_NULL = "case when isnan(d.temp) then null else d.temp end"


def _mean6(column: str) -> str:
    return f"round_even(avg({column}), 6)"


def _in_order(source: str) -> str:
    """Rows with their place in the day: by record number, none last, then by all other columns."""
    rest = ", ".join(f"{c} nulls first" for c in RAW_HOUR_COLUMNS if c != "dteday")
    return (
        "select *, row_number() over (partition by dteday order by"
        f" coalesce(try_cast(instant as bigint), 9223372036854775807), {rest}) as place from {source}"
    )


def _first(c: str) -> str:
    present = f"{c} is not null" + (f" and not isnan({c})" if c == "temp" else "")
    return f"arg_min({c}, place) filter ({present}) as {c}"


def _daily(source: str) -> str:
    """The daily table: groups by the text date, numbered by date."""
    firsts = ", ".join(_first(c) for c in ("season", "yr", "mnth", "holiday", "weekday", "workingday"))
    present = {c: f"case when isnan({c}) then null else {c} end" for c in ("temp", "atemp", "hum", "windspeed")}
    means = ", ".join(f"{_mean6(value)} as {c}" for c, value in present.items())
    sums = ", ".join(f"cast(coalesce(sum({c}), 0) as bigint) as {c}" for c in ("casual", "registered", "cnt"))
    return f"""day_raw as (
      select row_number() over (order by dteday) as instant, *
      from (select dteday, {firsts}, cast(trunc(avg(weathersit) + 0.5) as bigint) as weathersit, {means}, {sums}
            from ({_in_order(source)}) where dteday is not null group by dteday))"""


_DAY_RAW = f"{_HOUR_RAW}, {_daily('hour_raw')}"


def _projected(source: str, fields) -> str:
    def cast(f):
        if f.raw == "temp":
            return f"case when isnan(temp) then null else temp end as {f.silver}"
        return f"try_cast({f.raw} as {f.type}) as {f.silver}"

    return f"projected as (select {', '.join(cast(f) for f in fields)} from {source})"


def _ranked(fields) -> str:
    rest = ["ride_date", *[f.silver for f in fields if f.silver not in ("ride_id", "ride_date")]]
    order = ", ".join(f"{c} desc nulls last" for c in rest)
    return f"ranked as (select *, row_number() over (partition by ride_id order by {order}) as rn from projected)"


def _silver(base: str, source: str, fields) -> str:
    return (
        f"{base}, {_projected(source, fields)}, {_ranked(fields)}, "
        "silver as (select * exclude (rn) from ranked where rn = 1)"
    )


_PROJECTED_HOUR = f"{_HOUR_DIRTY}, {_projected('hour_dirty', HOUR_FIELDS)}"
_RANKED_HOUR = f"{_PROJECTED_HOUR}, {_ranked(HOUR_FIELDS)}"
_SILVER_HOUR = _silver(_HOUR_DIRTY, "hour_dirty", HOUR_FIELDS)
_SILVER_DAY = _silver(_DAY_DIRTY, "day_dirty", DAY_FIELDS)
# The faulty hours' dates need the lenient parse.
_SILVER_OF_FAULTY = _silver(
    f"{_HOUR_FAULTY}, parsed as (select * replace ({_date('dteday')} as dteday) from hour_faulty)", "parsed", HOUR_FIELDS
)

_CLEANED = "d.dteday is not null and d.cnt is not null and try_cast(d.dteday as date) is not null"
_SILVER_OF_CLEANED = _silver(
    f"{_HOUR_DIRTY}, cleaned as (select * from hour_dirty d where {_CLEANED})", "cleaned", HOUR_FIELDS
)

# A raw file read with its typed schema, or with detected types.
_TYPED = {f.raw: f"cast(h.{f.raw} as {f.type})" for f in HOUR_FIELDS}
_TYPED_HOUR = f"with {_HOUR_RAW} select {_columns(_TYPED)} from hour_raw h"
_TYPED_DAY = f"with {_DAY_RAW} select {_columns(_TYPED, ('hr',))} from day_raw h"

_RAW = f"with {_HOUR_RAW} select * from hour_raw"
_DAY = f"with {_DAY_RAW} select * from day_raw"

_NOTE = r"""case registered % 4 when 0 then '  "' || instant || '", x ' when 1 then 'a\\b\\"' || instant || '\\'
  when 2 then ' ' end as note"""

_INFERRED = {
    **{f.raw: f"cast(d.{f.raw} as {f.type})" for f in HOUR_FIELDS},
    "instant": "d.instant",
    "dteday": "d.dteday",
    "temp": _TEMP_NULL,
}

_CLEAN = {"dteday": "try_cast(d.dteday as date)", "temp": _TEMP_NULL}


def _cleaned(grain: str) -> str:
    """Cleaned rows as written: parsed date, other columns as they were."""
    skip = ("hr",) if grain == "day" else ()
    return f"with {_HOUR_DIRTY} select {_columns(_CLEAN, skip, 'd')} from hour_dirty d where {_CLEANED}"


def _cleaned_typed(grain: str) -> str:
    """Cleaned rows read back with the typed schema, where a bad integer is null."""
    skip = ("hr",) if grain == "day" else ()
    typed = {f.raw: f"try_cast(d.{f.raw} as {f.type})" for f in HOUR_FIELDS} | {"temp": _TEMP_NULL}
    return f"with {_HOUR_DIRTY} select {_columns(typed, skip, 'd')} from hour_dirty d where {_CLEANED}"


def _from_silver(select: str) -> str:
    return f"with {_SILVER_HOUR} {select}"


def _demand(*keys: str, where: str = "true", tail: str = "") -> str:
    names = ", ".join(keys)
    return _from_silver(
        f"select {names}, count(*) as n_records, {_mean6('total_rides')} as avg_rides"
        f" from silver where {where} group by {names} {tail}"
    )


def _rentals(*keys: str) -> str:
    names = ", ".join(keys)
    return f"""select {names}, count(*) as n_records, cast(sum(total_rides) as bigint) as total_rides,
      {_mean6("total_rides")} as avg_rides, cast(sum(casual_users) as bigint) as casual_users,
      cast(sum(registered_users) as bigint) as registered_users
      from silver group by {names}"""


_RENTAL_METRICS = f"""select year_flag, month, cast(sum(total_rides) as bigint) as total_rides,
  {_mean6("total_rides")} as avg_rides, min(total_rides) as min_rides, max(total_rides) as max_rides,
  round_even(cast(sum(casual_users) as double) / nullif(cast(sum(total_rides) as double), 0), 6) as casual_share
  from silver group by year_flag, month"""


def _relation(column: str) -> str:
    def finite(expression: str) -> str:
        inner = f"(select {expression} as v from silver)"
        return f"(select case when isnan(v) then null else round_even(v, 6) end from {inner})"

    return _from_silver(
        f"select cast(regr_count(total_rides, {column}) as bigint) as n_pairs,"
        f" {finite(f'corr(total_rides, {column})')} as correlation,"
        f" {finite(f'regr_slope(total_rides, {column})')} as slope,"
        f" {finite(f'regr_intercept(total_rides, {column})')} as intercept from silver"
    )


def _bins(column: str) -> str:
    return _from_silver(
        f"select cast(floor({column} * 10) as bigint) as bin, count(*) as n_records,"
        f" {_mean6('total_rides')} as avg_rides from silver where {column} is not null group by 1"
    )


# Which columns hold doubles.
DOUBLES = {
    "temp", "atemp", "hum", "windspeed", "temperature", "feels_like_temperature", "humidity", "avg_rides", "casual_share",
    "avg_temperature", "avg_feels_like_temperature", "avg_humidity", "avg_windspeed",
}
SILVER_HOUR_COLUMNS = [f.silver for f in HOUR_FIELDS]
SILVER_DAY_COLUMNS = [f.silver for f in DAY_FIELDS]
RENTAL_COLUMNS = ["n_records", "total_rides", "avg_rides", "casual_users", "registered_users"]


def _checksum(columns: list[str]) -> str:
    """Sum over all rows of a number from the MD5 of all cells; doubles with six digits."""

    def cell(c: str) -> str:
        value = f"cast(round(case when isnan({c}) then null else {c} end * 1e6) as bigint)" if c in DOUBLES else c
        return f"coalesce(cast({value} as varchar), '-')"

    row = f"concat_ws('|', {', '.join(cell(c) for c in sorted(columns))})"
    return f"cast(sum(cast('0x' || substr(md5({row}), 1, 8) as bigint)) as bigint)"


def _contents(tables: dict[str, tuple[str, list[str]]], with_: str) -> str:
    """Per table its rows, columns and checksum; ``tables`` has the source and its columns."""
    return f"with {with_} " + " union all ".join(
        f"select '{name}' as table_name, count(*) as n_rows, cast({len(columns)} as bigint) as n_columns,"
        f" {_checksum(columns)} as checksum from {source}"
        for name, (source, columns) in tables.items()
    )


def _load_route(*tables: str) -> str:
    parts = {
        "silver_day": ("silver_d", SILVER_DAY_COLUMNS),
        "silver_hour": ("silver", SILVER_HOUR_COLUMNS),
        "gold_day": ("silver_d", SILVER_DAY_COLUMNS),
        "gold_monthly": _GOLD["monthly"],
    }
    day = (
        f"{_projected('hour_dirty', DAY_FIELDS)}, {_ranked(DAY_FIELDS)}, "
        "silver_d as (select * exclude (rn) from ranked where rn = 1)"
    )
    for name in ("projected", "ranked"):
        day = day.replace(f"{name} as (", f"{name}_d as (").replace(f"from {name}", f"from {name}_d")
    return _contents({t: parts[t] for t in tables}, f"{_SILVER_HOUR}, {day}")


_WEATHER_METRICS = f"""select weather_situation, count(*) as n_records, {_mean6("temperature")} as avg_temperature,
  {_mean6("feels_like_temperature")} as avg_feels_like_temperature, {_mean6("humidity")} as avg_humidity,
  {_mean6("windspeed")} as avg_windspeed, {_mean6("total_rides")} as avg_rides
  from silver group by weather_situation"""
_METRICS = ["total_rides", "avg_rides", "min_rides", "max_rides", "casual_share"]
_WEATHER = ["n_records", "avg_temperature", "avg_feels_like_temperature", "avg_humidity", "avg_windspeed", "avg_rides"]

# Gold tables of silver hours.
_GOLD = {
    "monthly": (f"({_rentals('year_flag', 'month')})", ["year_flag", "month", *RENTAL_COLUMNS]),
    "yearly": (f"({_rentals('year_flag')})", ["year_flag", *RENTAL_COLUMNS]),
    "rental_metrics": (f"({_RENTAL_METRICS})", ["year_flag", "month", *_METRICS]),
    "weather_metrics": (f"({_WEATHER_METRICS})", ["weather_situation", *_WEATHER]),
}


def _flow_load() -> str:
    tables = {
        "loaded_silver_day": ("cleaned", RAW_DAY_COLUMNS),
        "loaded_silver_hour": ("cleaned", RAW_HOUR_COLUMNS),
        "loaded_gold_day": ("cleaned", RAW_DAY_COLUMNS),
    }
    tables |= {f"loaded_gold_{name}": spec for name, spec in _GOLD.items()}
    return _contents(tables, _SILVER_OF_CLEANED)


def _flow_medallion() -> str:
    # Days are made of the hours before cleaning; those whose text is no date are cleaned away.
    days = ", ".join(f"{f.raw} as {f.silver}" for f in DAY_FIELDS)
    report = """accounted as (
      select 'hour' as dataset, count(*) as rows_in, count(*) filter (d.dteday is null or d.cnt is null) as dropped_null,
        count(*) filter (d.dteday is not null and d.cnt is not null and try_cast(d.dteday as date) is null) as dropped_bad_date,
        (select count(*) from cleaned) as rows_out from hour_dirty d
      union all
      select 'day', count(*), 0, count(*) filter (try_cast(dteday as date) is null), (select count(*) from days) from day_raw)"""
    daily = f"{_daily('hour_dirty')}, days as (select {days} from day_raw where try_cast(dteday as date) is not null), {report}"
    tables = {
        "silver_day": ("days", SILVER_DAY_COLUMNS),
        "silver_hour": ("silver", SILVER_HOUR_COLUMNS),
        "gold_day": ("days", SILVER_DAY_COLUMNS),
        **{f"gold_{name}": spec for name, spec in _GOLD.items()},
        "cleaning": ("accounted", ["dataset", "rows_in", "dropped_null", "dropped_bad_date", "rows_out"]),
    }
    return _contents(tables, f"{_SILVER_OF_CLEANED}, {daily}")


def _month_day(column: str) -> str:
    return f"month({column}) * 100 + day({column})"


_SEASON_CHECK = f"""with {_SILVER_HOUR}, dated as (
    select season, strftime(ride_date, '%m-%d') as md, {_month_day("ride_date")} as n
    from silver where ride_date is not null)
  select season, min(md) as first_month_day, max(md) as last_month_day, count(*) as n_records,
    count(*) filter (season <> case when n between 321 and 620 then 1 when n between 621 and 922 then 2
      when n between 923 and 1220 then 3 else 4 end) as n_mismatches
  from dated group by season"""

_DOMAINS = f"with {_SILVER_HOUR} " + " union all ".join(
    f"select '{rule}' as rule, count(*) filter (not ({c} between {lo} and {hi})) as n_violations from silver"
    for rule, c, lo, hi in FEED_RULES
)

_SEASON_RANKING = f"""with {_SILVER_HOUR}, named as (
    select case when month between 3 and 5 then 'spring' when month between 6 and 8 then 'summer'
      when month between 9 and 11 then 'autumn' when month in (12, 1, 2) then 'winter' end as season_name,
      total_rides from silver),
  seasons as (select season_name, count(*) as n_records, {_mean6("total_rides")} as avg_rides
    from named group by season_name)
  select *, row_number() over (order by avg_rides desc nulls last, season_name nulls last) as position from seasons"""

_NULL_CELLS = " + ".join(
    f"(d.{c} is null{' or isnan(d.temp)' if c == 'temp' else ''})::bigint" for c in RAW_HOUR_COLUMNS
)

_DIRTY_TYPES = {
    "instant": "string", "dteday": "string", "temp": "double", "atemp": "double", "hum": "double",
    "windspeed": "double", "casual": "bigint", "registered": "bigint", "cnt": "bigint",
}
_SCHEMA_REPORT = f"with {_HOUR_DIRTY} " + " union all ".join(
    f"select cast({i} as bigint) as position, '{c}' as name, '{_DIRTY_TYPES.get(c, 'int')}' as type,"
    f" count(*) filter (d.{c} is not null{' and not isnan(d.temp)' if c == 'temp' else ''}) as n_values"
    " from hour_dirty d"
    for i, c in enumerate(RAW_HOUR_COLUMNS, 1)
)


def _label(column: str, name: str, labels: dict[int, str]) -> str:
    branches = " ".join(f"when {column} = {k} then '{v}'" for k, v in labels.items())
    return f"with {_PROJECTED_HOUR} select ride_id, {column}, case {branches} end as {name} from projected"


# Cells that hold a token for a missing value.
_TOKENS = _TYPED | {
    "dteday": "case when h.registered % 10 <> 3 then cast(h.dteday as date) end",
    "temp": "case when h.registered % 10 not in (4, 5) then h.temp end",
    "weathersit": "case when h.registered % 10 <> 6 then cast(h.weathersit as bigint) end",
    "casual": "case when h.registered % 10 not in (7, 8) then cast(h.casual as bigint) end",
}


def _two_digits(c: str) -> str:
    return f"cast(cast({c} as decimal(4,2)) as varchar)"


def _line(columns: list[str]) -> str:
    cells = {c: f"cast({c} as varchar)" for c in columns}
    cells |= {c: _two_digits(c) for c in ("temp", "atemp", "windspeed")}
    cells["hum"] = f"case when registered % 20 = 9 then 'damp' else {_two_digits('hum')} end"
    cells["instant"] = """case when registered % 20 = 11 then '"' || instant || '"' else instant end"""
    return f"concat_ws(',', {', '.join(cells[c] for c in columns)})"


# Lines of CSV and what is wrong with them.
_DAMAGED = f"""{_HOUR_RAW}, damaged as (select *,
    case registered % 20 when 7 then {_line(RAW_HOUR_COLUMNS[:-1])}
      when 8 then {_line(RAW_HOUR_COLUMNS)} || ',"a,b"' else {_line(RAW_HOUR_COLUMNS)} end as line,
    case registered % 20 when 7 then 'short' when 8 then 'long' when 9 then 'unfit' else 'none' end as fault
  from hour_raw)"""
_TOLD = {f.raw: f"cast(d.{f.raw} as {f.type})" for f in HOUR_FIELDS} | {
    **{c: f"cast({_two_digits(f'd.{c}')} as double)" for c in ("temp", "atemp", "windspeed")},
    "dteday": "d.dteday",
    "hum": f"case when d.registered % 20 = 9 then 'damp' else {_two_digits('d.hum')} end",
}

ORACLE: dict[str, str] = {
    # sources
    "scan_hour_raw": _TYPED_HOUR,
    "bronze_external_hour": _TYPED_HOUR,
    "bronze_external_day": _TYPED_DAY,
    "scan_csv_inferred": f"with {_HOUR_DIRTY} select {_columns(_INFERRED, (), 'd')} from hour_dirty d",
    "scan_optional_inputs": _TYPED_HOUR,
    "scan_by_format": _contents({"day.csv": ("day_raw", RAW_DAY_COLUMNS), "hour.parquet": ("hour_raw", RAW_HOUR_COLUMNS)}, _DAY_RAW),
    "bronze_external_day_tokens": f"with {_DAY_RAW} select {_columns(_TOKENS, ('hr',))} from day_raw h",
    "bronze_external_hour_tokens": f"with {_HOUR_RAW} select {_columns(_TOKENS)} from hour_raw h",
    "scan_fault_counts": f"""with {_DAMAGED} select fault, count(instant) as n_rows
      from (values ('none'), ('short'), ('long'), ('unfit')) f(fault) left join damaged using (fault) group by fault""",
    "scan_set_aside": f"with {_DAMAGED} select line, fault from damaged where fault <> 'none'",
    "scan_told_inferred": f"with {_DAMAGED} select {_columns(_TOLD, (), 'd')} from damaged d where fault not in ('short', 'long')",
    # sinks
    "sink_raw_csv": f"with {_HOUR_RAW} select *, {_NOTE} from hour_raw",
    "sink_raw_parquet": _RAW,
    "sink_processed_csv": f"with c as ({_cleaned('hour')}) select *, {_NOTE} from c",
    "sink_processed_parquet": _cleaned("hour"),
    "publish_raw": _RAW,
    "load_truncate": _RAW,
    "load_route_silver": _load_route("silver_day", "silver_hour"),
    "load_route_gold": _load_route("gold_day", "gold_monthly"),
    "load_route_both": _load_route("silver_day", "silver_hour", "gold_day", "gold_monthly"),
    "silver_ctas_day": f"with {_SILVER_DAY} select * from silver",
    "silver_ctas_hour": f"with {_SILVER_HOUR} select * from silver",
    # projections
    "project_silver_day": f"with {_DAY_DIRTY}, {_projected('day_dirty', DAY_FIELDS)} select * from projected",
    "project_silver_hour": f"with {_PROJECTED_HOUR} select * from projected",
    "project_passthrough": f"with {_HOUR_DIRTY} select dteday as ride_date from hour_dirty",
    "project_star_plus": f"with {_RANKED_HOUR} select * from ranked",
    "project_star_except": f"with {_RANKED_HOUR} select * exclude (rn) from ranked where rn = 1",
    "project_leading_column": f"with {_HOUR_RAW} select cast(instant as bigint) as row_key, * from hour_raw",
    "project_day_columns": _DAY,
    "cte_chain": f"""with {_HOUR_DIRTY}, cleaned as (
        select try_cast(instant as bigint) as ride_id, try_cast(dteday as date) as ride_date,
               cast(hr as bigint) as ride_hour, cnt as total_rides from hour_dirty),
      ranked as (select *, row_number() over (partition by ride_id
        order by ride_date desc nulls last, ride_hour desc nulls last, total_rides desc nulls last) as rn
        from cleaned)
      select * exclude (rn) from ranked where rn = 1""",
    # filters
    "filter_required_not_null": f"""with {_HOUR_FAULTY} select {_columns({}, (), "d")}
      from hour_faulty d where d.dteday is not null and d.cnt is not null""",
    "filter_bad_dates": f"""with {_HOUR_FAULTY} select {_columns({"dteday": _date("d.dteday")}, (), "d")}
      from hour_faulty d where {_date("d.dteday")} is not null""",
    "filter_rank_one": f"""with {_RANKED_HOUR}
      select ride_id, ride_date, ride_hour, total_rides from ranked where rn = 1""",
    "check_required_columns": f"""with {_HOUR_DIRTY}
      select 'dteday' as "column", true as present, count(*) filter (dteday is null) as n_missing from hour_dirty
      union all select 'cnt', true, count(*) filter (cnt is null) from hour_dirty
      union all select 'station', false, count(*) from hour_dirty""",
    "filter_null_group_key": f"""with {_HOUR_DIRTY}
      select try_cast(dteday as date) as dteday, count(*) as n_rows from hour_dirty
      where try_cast(dteday as date) is not null group by 1""",
    # aggregations
    "rollup_day": _DAY,
    "agg_first_non_null": f"with {_HOUR_DIRTY} select dteday, "
    + ", ".join(map(_first, ("season", "yr", "mnth", "holiday", "weekday", "workingday", "hr", "temp", "cnt")))
    + f" from ({_in_order('hour_dirty')}) where dteday is not null group by dteday",
    "agg_half_up_mean": f"""with {_HOUR_RAW}
      select dteday, cast(trunc(avg(weathersit) + 0.5) as bigint) as weathersit from hour_raw group by dteday""",
    "agg_mean_round6": f"""with {_HOUR_DIRTY} select dteday, round_even(avg({_TEMP_NULL}), 6) as temp,
      {_mean6("atemp")} as atemp, {_mean6("hum")} as hum, {_mean6("windspeed")} as windspeed
      from hour_dirty d group by dteday""",
    "agg_sum_zero": f"""with {_HOUR_DIRTY} select dteday, cast(coalesce(sum(casual), 0) as bigint) as casual,
      cast(coalesce(sum(registered), 0) as bigint) as registered, cast(coalesce(sum(cnt), 0) as bigint) as cnt
      from hour_dirty group by dteday""",
    "agg_shape": f"with {_HOUR_DIRTY} select count(*) as n_rows, cast(17 as bigint) as n_cols from hour_dirty",
    "agg_null_cells": f"with {_HOUR_DIRTY} select cast(sum({_NULL_CELLS}) as bigint) as n_nulls from hour_dirty d",
    "udaf_half_up_mean": f"""with {_HOUR_RAW}
      select dteday, cast(trunc(avg(weathersit) + 0.5) as bigint) as weathersit from hour_raw group by dteday""",
    "udaf_exact_median": f"""with {_HOUR_DIRTY} select dteday, median(cnt) as cnt from hour_dirty
      where dteday is not null and cnt is not null group by dteday""",
    # windows, order, top-k
    "dedup_latest_day": f"with {_SILVER_DAY} select * from silver",
    "dedup_latest_hour": f"with {_SILVER_HOUR} select * from silver",
    "sequence_id": f"""with {_HOUR_RAW}
      select row_number() over (order by ride_date) as instant, * from (
        select cast(dteday as date) as ride_date, cast(sum(cnt) as bigint) as total_rides
        from hour_raw group by 1)""",
    "sequence_id_distributed": f"""with {_HOUR_RAW}
      select row_number() over (order by dteday, instant, hr, cnt) as position, dteday, instant, hr, cnt
      from hour_raw""",
    "sort_by_date": f"{_DAY} order by dteday",
    "sort_desc_nulls_last": f"""with {_PROJECTED_HOUR} select ride_id, ride_date, ride_hour, total_rides from projected
      order by ride_date desc nulls last, ride_id desc nulls last""",
    "top1_per_key": f"with {_SILVER_HOUR} select * from silver",
    "preview_head": f"{_DAY} order by instant limit 3",
    # scalar functions
    "safe_cast_int": f"""with {_HOUR_DIRTY} select instant, try_cast(instant as bigint) as ride_id,
      try_cast(round(hum * 50 + 0.25) as bigint) as quantity from hour_dirty""",
    "safe_cast_double": f"""with {_HOUR_DIRTY} select instant, try_cast(instant as double) as id_value,
      {_TEMP_NULL} as temperature from hour_dirty d""",
    "parse_date_lenient": f"""with {_HOUR_FAULTY} select instant, dteday, {_date("dteday")} as ride_date,
      try_cast((yr + 1995) || '-' || mnth || '-' || hr as date) as number_date from hour_faulty""",
    "int_truncate": f"""with {_HOUR_RAW}
      select instant, hum, cast(trunc(hum * 10 - 4.75) as bigint) as truncated from hour_raw""",
    "round_half_even": f"""with {_HOUR_RAW}
      select instant, round_even(cast(cnt as double) / 2, 0) as rounded from hour_raw""",
    "is_missing": f"""with {_HOUR_DIRTY} select instant, temp is null or isnan(temp) as temp_missing,
      cnt is null as cnt_missing from hour_dirty""",
    # data quality
    "validate_dataset": f"""with {_HOUR_DIRTY}, p as (
        select count(*) as n_rows, cast(sum({_NULL_CELLS}) as bigint) as n_nulls from hour_dirty d)
      select 'hour' as dataset, n_rows, cast(17 as bigint) as n_cols, n_nulls, n_rows >= 100 as rows_ok,
        true as cols_ok, n_rows >= 100 as valid from p""",
    "cleaning_report": f"""with {_HOUR_FAULTY}, told as (
        select dteday is null or cnt is null as absent, {_date("dteday")} is null as bad from hour_faulty)
      select count(*) as rows_in, count(*) filter (absent) as dropped_null,
        count(*) filter (not absent and bad) as dropped_bad_date, count(*) filter (not absent and not bad) as rows_out
      from told""",
    "schema_report": _SCHEMA_REPORT,
    "check_total_invariant": f"""with {_SILVER_OF_FAULTY}
      select count(*) as n_rows,
        count(*) filter (total_rides <> casual_users + registered_users) as n_violations,
        count(*) filter (total_rides is null) as n_null_totals,
        count(*) filter (total_rides is not null and (casual_users is null or registered_users is null)) as n_null_parts
      from silver""",
    "season_calendar_check": _SEASON_CHECK,
    "check_domains": _DOMAINS,
    # gold
    "gold_monthly": _from_silver(_rentals("year_flag", "month")),
    "gold_yearly": _from_silver(_rentals("year_flag")),
    "gold_rental_metrics": _from_silver(_RENTAL_METRICS),
    "gold_weather_metrics": _from_silver(_WEATHER_METRICS),
    # demand
    "demand_by_season": _demand("season"),
    "demand_by_hour": _demand("ride_hour"),
    "demand_by_weekday": _demand("weekday"),
    "temp_vs_rides": _relation("temperature"),
    "temp_bins": _bins("temperature"),
    "humidity_vs_rides": _relation("humidity"),
    "humidity_bins": _bins("humidity"),
    "demand_by_weather_season": _demand("weather_situation", "season"),
    "monthly_evolution": _from_silver(_rentals("year_flag", "month") + " order by year_flag, month"),
    "demand_filtered": _demand(
        "ride_hour", where="season in (2, 3) and weekday in (1, 2, 3, 4, 5) and weather_situation = 1"
    ),
    "peak_hours": _demand("ride_hour", tail="order by avg_rides desc nulls last, ride_hour limit 2"),
    "workingday_vs_weekend": _demand("workingday"),
    "peak_weekday": _demand("weekday", tail="order by avg_rides desc nulls last, weekday limit 1"),
    "peak_month": _demand("month", tail="order by avg_rides desc nulls last, month limit 1"),
    "trough_month": _demand("month", tail="order by avg_rides nulls last, month limit 1"),
    "season_ranking": _SEASON_RANKING,
    # data dictionary
    "denormalize_temp": f"""with {_PROJECTED_HOUR}
      select ride_id, round_even(temperature * 41.0::double, 6) as celsius from projected""",
    "label_season": _label("season", "season_name", {1: "spring", 2: "summer", 3: "fall", 4: "winter"}),
    "label_year": f"with {_PROJECTED_HOUR} select ride_id, year_flag, year_flag + cast(1995 as bigint) as year from projected",
    "label_weather": _label("weather_situation", "weather_name", {1: "good", 2: "cloudy", 3: "rain", 4: "storm"}),
    # flows
    "flow_extract_day": _contents(
        {f"{p}{n}": (f"{n}_raw", c) for p in ("", "published_") for n, c in (("day", RAW_DAY_COLUMNS), ("hour", RAW_HOUR_COLUMNS))},
        _DAY_RAW,
    ),
    "flow_clean_accounting": f"""with {_DAMAGED} select 'hour' as dataset, count(*) as rows_in,
      count(*) filter (fault <> 'none') as dropped_malformed, cast(0 as bigint) as dropped_null,
      cast(0 as bigint) as dropped_bad_date, count(*) filter (fault = 'none') as rows_out from damaged""",
    "flow_clean_day": _cleaned_typed("day"),
    "flow_clean_hour": _cleaned_typed("hour"),
    "flow_silver_day": f"with {_SILVER_DAY} select * from silver",
    "flow_silver_hour": f"with {_SILVER_HOUR} select * from silver",
    "flow_load": _flow_load(),
    "flow_medallion": _flow_medallion(),
}
