"""Shared pieces of the DuckDB statements that check the queries."""

from __future__ import annotations

from skymart.sources.events import CONDITIONS, OTHER_CONDITION

_CONDITION = " ".join(f"when '{kind}' then '{text}'" for kind, text in CONDITIONS.items())

#: The ``events`` table as observations.
OBS = f"""obs as (
  select event_id as raw_id, ts as observed_at, time_bucket(interval '3 hours', ts) as slot,
    concat('12.71.', lpad(cast(user_id % 21 + 1 as varchar), 2, '0'), '.',
           cast(1001 + user_id // 21 as varchar)) as location,
    'Events' as source,
    cast((350 + user_id % 21) / 100.0 as decimal(9,6)) as latitude,
    cast((98600 + user_id // 21) / 1000.0 as decimal(9,6)) as longitude,
    cast((1800 + cents // 10) / 100.0 as decimal(5,2)) as temperature,
    cast(k + 5 as decimal(5,2)) as humidity,
    cast(1000 + k % 20 as decimal(7,2)) as pressure,
    cast(event_id * 37 % 360 as int) as wind_deg,
    cast(event_id % 50 as decimal(5,2)) as wind_speed,
    cast(case when event_type = 'purchase' then (cents // 10) / 100.0 else 0 end
         as decimal(6,2)) as rainfall,
    cast(k % 17 as decimal(4,2)) as uv_index,
    case when k % 10 <> 0 then cast(k / 10.0 as decimal(5,2)) end as visibility,
    cast(k as decimal(5,2)) as cloud_coverage,
    event_type as condition_code,
    case event_type {_CONDITION} else '{OTHER_CONDITION}' end as condition_desc
  from (select *, cast(props->>'$.k' as int) as k, cast(round(value * 100) as bigint) as cents
        from events) e
)"""

_CHECKED = """
    case when temperature between -90 and 60 then temperature end as temperature,
    case when humidity between 0 and 100 then humidity end as humidity,
    case when pressure between 300 and 1100 then pressure end as pressure,
    case when wind_speed >= 0 then wind_speed end as wind_speed,
    case when rainfall >= 0 then rainfall end as rainfall,
    case when uv_index between 0 and 16 then uv_index end as uv_index,
    case when visibility >= 0 then visibility end as visibility,
    case when cloud_coverage between 0 and 100 then cloud_coverage end as cloud_coverage"""


def cleaned(name: str = "cleaned", time: str = "observed_at") -> str:
    """C1-C6 over ``obs``, by event time or by slot."""
    return f"""{name} as (
  select raw_id, {time} as observed_at, location, latitude, longitude, source, wind_deg,
    condition_code, condition_desc, {_CHECKED}
  from (select *, row_number() over (partition by {time}, location order by raw_id) as rn
        from obs) d where rn = 1
)"""


def bands(column: str, bounds: list[tuple[float, str]], below: str) -> str:
    cases = " ".join(f"when {column} >= {bound} then '{label}'" for bound, label in bounds)
    return f"case when {column} is null then 'Tidak Diketahui' {cases} else '{below}' end"


TEMP_CLASS = bands("temperature", [(38, "Sangat Panas"), (33, "Panas"), (20, "Normal")], "Dingin")
HUMIDITY_CLASS = bands(
    "humidity", [(85, "Sangat Lembap"), (70, "Lembap"), (40, "Normal")], "Kering"
)
WIND_CLASS = bands("wind_speed", [(40, "Kencang"), (20, "Sedang"), (5, "Ringan")], "Tenang")
RAIN_CLASS = bands(
    "rainfall", [(20, "Hujan Lebat"), (7.5, "Hujan Sedang"), (0.5, "Hujan Ringan")], "Tidak Hujan"
)
CLASSES = (
    f"{TEMP_CLASS} as temp_class, {HUMIDITY_CLASS} as humidity_class, "
    f"{WIND_CLASS} as wind_class, {RAIN_CLASS} as rainfall_class"
)


def cents(column: str) -> str:
    return f"cast({column} * 100 as bigint)"


def mean(column: str, over: str = "") -> str:
    """Exact mean as double."""
    total, count = f"sum({cents(column)}) {over}", f"count({column}) {over}"
    return f"(cast({total} as double) / nullif(100 * {count}, 0))"


def rounded_mean(column: str, places: int, over: str = "") -> str:
    """Mean rounded half away from zero as double."""
    total, count = f"cast(sum({column}) {over} as double)", f"count({column}) {over}"
    return f"cast(round(cast({total} / nullif({count}, 0) as decimal(18,8)), {places}) as double)"


def _fact(name: str, average: str, high: str, low: str) -> str:
    return f"""{name} as (
  select *, location as district, {CLASSES}, {average} as temp_avg, {high} as temp_max,
    {low} as temp_min
  from slotted
)"""


def _cent_average(over: str, condition: str = "") -> str:
    total = f"sum({cents('temperature')}) {condition} {over}"
    count = f"count(temperature) {condition} {over}"
    return (
        f"cast(cast((2 * {total} + {count}) // nullif(2 * {count}, 0) as double) / 100.0"
        " as decimal(5,2))"
    )


_ALL = "over (partition by location)"
SLOTTED = cleaned("slotted", "slot")
#: The warehouse's facts with their dimension values, after one load of everything.
FACT = f"with {OBS}, {SLOTTED}, " + _fact(
    "fact", _cent_average(_ALL), f"max(temperature) {_ALL}", f"min(temperature) {_ALL}"
)

#: Last slot of the first of two loads.
CUT = "2024-01-15 12:00:00"


def _stepwise(function: str) -> str:
    early = f"filter (where observed_at <= timestamp '{CUT}')"
    return (
        f"case when observed_at <= timestamp '{CUT}' "
        f"then {function.format(f=early)} else {function.format(f='')} end"
    )


#: The same after two loads: features are as of the load that wrote the row.
FACT_IN_STEPS = f"with {OBS}, {SLOTTED}, " + _fact(
    "fact",
    f"case when observed_at <= timestamp '{CUT}' then "
    + _cent_average(_ALL, f"filter (where observed_at <= timestamp '{CUT}')")
    + f" else {_cent_average(_ALL)} end",
    _stepwise("max(temperature) {f} " + _ALL),
    _stepwise("min(temperature) {f} " + _ALL),
)


def doubles(*columns: str) -> str:
    return ", ".join(f"cast({c} as double) as {c}" for c in columns)
