"""SQL that gives the same rows as each registered query, for DuckDB.

Sums are taken over DECIMAL(18,7) where that keeps the value, else over doubles, and rounding is spelled out, so that both
engines work on the same numbers.
"""

from __future__ import annotations

import math

from checks import fixtures as fx
from meterlake import config
from meterlake.schema import MEASURES

P = "Active_Power_kW"


# --- snippets -------------------------------------------------------------------


def _lanes(x: str) -> tuple[str, str]:
    """A value as decimal where that keeps it to a millionth, and as double what is left, or else all of it."""
    v, d = f"CAST({x} AS DOUBLE)", f"TRY_CAST({x} AS DECIMAL(18,7))"
    close = f"coalesce(abs(CAST({d} AS DOUBLE) - {v}) <= abs({v}) * 1e-6, false)"
    return f"CASE WHEN {close} THEN {d} END", f"CASE WHEN {close} THEN {v} - CAST({d} AS DOUBLE) ELSE {v} END"


def _joined(fixed: str, rest: str) -> str:
    s = f"CAST({fixed} AS DOUBLE)"
    return f"coalesce({s} + {rest}, {s}, {rest})"


def SO(x: str, over: str) -> str:
    """Sum over a window."""
    return _joined(*(f"SUM({lane}) OVER {over}" for lane in _lanes(x)))


def S(x: str) -> str:
    return _joined(*(f"SUM({lane})" for lane in _lanes(x)))


def A(x: str) -> str:
    return f"({S(x)} / NULLIF(COUNT({x}), 0))"


def R(x: str, n: int) -> str:
    return f"(sign({x}) * floor(abs({x}) * 1e{n} + 0.5) / 1e{n} + CAST(0 AS DOUBLE))"


def PCT(part: str, whole: str, n: int = 2) -> str:
    return R(f"(CAST({part} AS DOUBLE) * 100.0 / NULLIF({whole}, 0))", n)


def WA(x: str, over: str) -> str:
    """Average over a window, from an exact sum."""
    return f"({SO(x, over)} / NULLIF(COUNT({x}) OVER {over}, 0))"


def GROWTH(now: str, before: str) -> str:
    return f"((({now}) - ({before})) / NULLIF({before}, 0) * 100.0)"


def Q(x: str, p: float) -> str:
    """Linear quantile spelled out, since the built-in one fuses its multiply and add."""
    pos = f"((len(l) - 1) * CAST({p} AS DOUBLE))"
    lo, hi = (f"l[CAST({f}({pos}) AS BIGINT) + 1]" for f in ("floor", "ceil"))
    mixed = f"(ceil({pos}) - {pos}) * {lo} + ({pos} - floor({pos})) * {hi}"
    at = f"CASE WHEN {lo} = {hi} THEN {lo} ELSE {mixed} END"
    values = f"list_sort(array_agg({x}) FILTER (WHERE {x} IS NOT NULL))"
    return f"list_transform([{values}], lambda l: {at})[1]"


def I(x: str) -> str:  # noqa: E743
    return f"CAST({x} AS INTEGER)"


def N(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def COUNT_IF(cond: str) -> str:
    return f"COUNT(CASE WHEN {cond} THEN 1 END)"


def bands(v: str, fallback: str = "VeryHigh") -> str:
    parts = []
    for label, low, high in config.LOAD_BANDS:
        upper = "" if high is None else f" AND {v} < {high}"
        parts.append(f"WHEN {v} >= {low}{upper} THEN '{label}'")
    return f"CASE {' '.join(parts)} ELSE '{fallback}' END"


def seasons(month: str, preset: str = "monsoon") -> str:
    parts = [
        f"WHEN {month} IN ({', '.join(map(str, m))}) THEN '{n}'"
        for n, m in config.SEASONS[preset].items()
    ]
    return f"CASE {' '.join(parts)} ELSE 'Unknown' END"


def rating(v: str, table) -> str:
    parts = [f"WHEN {v} >= {f} THEN '{label}'" for f, label in table[:-1]]
    return f"CASE {' '.join(parts)} ELSE '{table[-1][1]}' END"


def peak(hour: str, preset: str = "standard") -> str:
    return f"({hour} IN ({', '.join(map(str, config.PEAK_HOURS[preset]))}))"


def monday0(ts: str) -> str:
    return f"(isodow({ts}) - 1)"


# --- shared tables ----------------------------------------------------------------

PF = """CASE WHEN Apparent_Power_kVA = 0 THEN 0.0
  WHEN Active_Power_kW / Apparent_Power_kVA < 0 THEN 0.0
  WHEN Active_Power_kW / Apparent_Power_kVA > 1 THEN 1.0
  ELSE Active_Power_kW / Apparent_Power_kVA END"""
RAW_PF = """CASE WHEN Apparent_Power_kVA = 0 THEN 0.0
  ELSE Active_Power_kW / NULLIF(Apparent_Power_kVA, 0) END"""

CTES: dict[str, str] = {
    "readings": fx.CTE_READINGS,
    "dup": fx.CTE_READINGS_DUP,
    "star": fx.CTE_STAR,
    "bulk": fx.CTE_BULK,
    "light": f"SELECT *, CAST({PF} AS DOUBLE) AS power_factor FROM readings",
    "raw_light": f"SELECT *, CAST({RAW_PF} AS DOUBLE) AS power_factor FROM readings",
    "fences": f"""SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
        FROM (SELECT {Q(P, 0.25)} AS q1, {Q(P, 0.75)} AS q3 FROM readings)""",
    "meters": "SELECT DISTINCT Meter_ID AS meter_id, 'Meter ' || Meter_ID AS meter_name FROM readings",
    "zones": """SELECT DISTINCT Zone_ID AS zone_id, 'Zone ' || Zone_ID AS zone_name,
        CAST(NULL AS VARCHAR) AS district FROM readings""",
    "star_readings": f"""SELECT reading_id AS _seq, ts AS "Timestamp", meter_id AS Meter_ID,
        zone_id AS Zone_ID, active_power_kw AS {P},
        CAST(reading_id % 64 - 12 AS DOUBLE) AS Outdoor_Temp_C, is_anomaly FROM star""",
    "star_meters": "SELECT CAST(c_custkey AS VARCHAR) AS meter_id, c_name AS meter_name FROM customer",
    "star_zones": """SELECT CAST(n_nationkey AS VARCHAR) AS zone_id, n_name AS zone_name, r_name AS district
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
}

_FACT_MEASURES = (
    "Voltage_V AS voltage_v, Current_A AS current_a, Active_Power_kW AS active_power_kw, "
    "Reactive_Power_kW AS reactive_power_kw, Apparent_Power_kVA AS apparent_power_kva, "
    "Frequency_Hz AS frequency_hz, power_factor, Sub_Meter_Kitchen AS sub_meter_kitchen, "
    "Sub_Meter_HVAC AS sub_meter_hvac, Outdoor_Temp_C AS outdoor_temp_c"
)


def _fact(source: str, measures: str, flag: str = "") -> str:
    return f"""SELECT _seq AS reading_id, "Timestamp" AS ts, Meter_ID AS meter_id, Zone_ID AS zone_id,
        {measures}, hour("Timestamp") AS hour_of_day,
        CASE WHEN {peak('hour("Timestamp")')} THEN 1 ELSE 0 END AS peak_hour_flag,
        {bands(P)} AS load_category, year("Timestamp") AS year, month("Timestamp") AS month,
        {monday0('"Timestamp"')} AS day_of_week, {seasons('month("Timestamp")')} AS season
        {flag} FROM {source}"""


CTES["fact"] = _fact("light", _FACT_MEASURES)
CTES["raw_fact"] = _fact("raw_light", _FACT_MEASURES)
CTES["flagged_fact"] = _fact(
    "light, fences",
    _FACT_MEASURES,
    f", CASE WHEN {P} < lo OR {P} > hi THEN 1 ELSE 0 END AS is_anomaly",
)
CTES["star_fact"] = _fact(
    "star_readings",
    "Active_Power_kW AS active_power_kw, Outdoor_Temp_C AS outdoor_temp_c",
    ", is_anomaly",
)
CTES["dup_light"] = f"SELECT *, CAST({PF} AS DOUBLE) AS power_factor FROM dup"
CTES["dup_fact"] = _fact("dup_light", _FACT_MEASURES)

NEEDS = {
    "dup": ["readings"],
    "light": ["readings"],
    "raw_light": ["readings"],
    "fences": ["readings"],
    "meters": ["readings"],
    "zones": ["readings"],
    "star_readings": ["star"],
    "fact": ["light"],
    "raw_fact": ["raw_light"],
    "flagged_fact": ["light", "fences"],
    "star_fact": ["star_readings"],
    "dup_light": ["dup"],
    "dup_fact": ["dup_light"],
}


def using(names: str, body: str) -> str:
    """The query with the shared tables it names, in order of need."""
    done: list[str] = []

    def add(n):
        for m in NEEDS.get(n, []):
            add(m)
        if n not in done:
            done.append(n)

    for n in names.split():
        add(n)
    body = body.strip()
    ctes = ",\n".join(f"{n} AS ({CTES[n]})" for n in done)
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


# --- flat catalogue -----------------------------------------------------------------

TS = '"Timestamp"'


def _flat() -> dict[str, str]:
    g_mean = f"(SELECT {A(P)} FROM readings)"
    off = f"({P} - {g_mean})"
    rms = R(f"sqrt(AVG({off} * {off}))", 2)
    day = f"CAST({TS} AS DATE)"
    out = {
        "G1_hourly_consumption": f"""SELECT strftime({TS}, '%Y-%m-%d %H:00:00') AS hour_bucket,
            {R(A(P), 2)} AS hourly_avg_power, MAX({P}) AS hourly_max_power, MIN({P}) AS hourly_min_power,
            COUNT(*) AS record_count FROM readings GROUP BY 1""",
        "G2_daily_consumption": f"""SELECT {day} AS consumption_date, dayname({day}) AS day_name,
            {R(S(P), 2)} AS daily_total_power, {R(A(P), 2)} AS daily_avg_power,
            MAX({P}) AS peak_power, MIN({P}) AS min_power FROM readings GROUP BY 1, 2""",
        "G3_zone_analysis": f"""SELECT Zone_ID, {R(A(P), 2)} AS Avg_Power_kW, {R(f'MAX({P})', 2)} AS Max_Power_kW,
            {R(f'MIN({P})', 2)} AS Min_Power_kW, COUNT(*) AS Record_Count
            FROM readings WHERE Zone_ID IS NOT NULL GROUP BY Zone_ID""",
        "G4_top_consumers": f"""SELECT Meter_ID, Zone_ID, COUNT(*) AS record_count, {R(A(P), 3)} AS avg_power_kw,
            {R(f'MAX({P})', 3)} AS peak_power_kw, {R(S(P), 2)} AS total_power_kwh
            FROM readings GROUP BY Meter_ID, Zone_ID
            ORDER BY avg_power_kw DESC NULLS LAST, Meter_ID, Zone_ID LIMIT 20""",
        "G5_peak_hours": f"""SELECT {I(f'hour({TS})')} AS hour_of_day, COUNT(*) AS record_count,
            {R(A(P), 2)} AS avg_power_during_hour, {R(f'MAX({P})', 2)} AS max_power_during_hour,
            CASE WHEN hour({TS}) BETWEEN 10 AND 21 THEN 'Peak' ELSE 'Off-Peak' END AS period_classification
            FROM readings GROUP BY hour({TS})""",
        "G6_anomaly_counts": f"""SELECT Meter_ID, Zone_ID, COUNT(*) AS total_readings, {R(A(P), 2)} AS avg_power_kw,
            {rms} AS stddev_power_kw, {COUNT_IF(f'{P} > {g_mean} + 3.0')} AS high_anomalies,
            {COUNT_IF(f'{P} < {g_mean} - 3.0')} AS low_anomalies
            FROM readings WHERE Meter_ID IS NOT NULL GROUP BY Meter_ID, Zone_ID""",
        "G9_daily_average": f"""SELECT strftime({TS}, '%Y-%m-%d') AS date, {R(A(P), 2)} AS daily_avg,
            COUNT(*) AS readings_per_day FROM readings GROUP BY 1""",
        "G10_daily_by_meter_latest": f"""SELECT {day} AS reading_date, Meter_ID, {R(A(P), 2)} AS hourly_avg,
            MAX({P}) AS hourly_max, MIN({P}) AS hourly_min FROM readings GROUP BY 1, 2
            ORDER BY reading_date DESC, Meter_ID LIMIT 1000""",
        "G11_cumulative_consumption": f"""WITH d AS (SELECT {day} AS reading_date,
            {S(P)} AS s FROM readings GROUP BY 1)
            SELECT reading_date, {R('CAST(s AS DOUBLE)', 2)} AS daily_consumption,
            {R(SO('s', '(ORDER BY reading_date)'), 2)} AS cumulative_consumption FROM d""",
        "G12_zone_statistics": f"""SELECT Zone_ID, COUNT(DISTINCT Meter_ID) AS meter_count, COUNT(*) AS total_readings,
            {R(A(P), 2)} AS avg_power_kw, {rms} AS stddev_power_kw, {R(f'MAX({P})', 2)} AS peak_power_kw,
            {R(f'MIN({P})', 2)} AS min_power_kw FROM readings WHERE Zone_ID IS NOT NULL GROUP BY Zone_ID""",
        "G14_consumption_spikes": f"""SELECT Meter_ID, MIN(Zone_ID) AS Zone_ID, {day} AS spike_date,
            MAX({P}) AS peak_power, {R(A(P), 2)} AS avg_power_that_day,
            {R(f'(MAX({P}) - {A(P)})', 2)} AS spike_magnitude
            FROM readings WHERE Meter_ID IS NOT NULL GROUP BY Meter_ID, {day}
            HAVING MAX({P}) > {g_mean} * 1.5
            ORDER BY spike_magnitude DESC, Meter_ID, spike_date LIMIT 500""",
        "G15_load_volatility": f"""SELECT {day} AS reading_date, {rms} AS daily_volatility, {R(A(P), 2)} AS daily_avg,
            {R(f'MAX({P})', 2)} AS daily_peak, COUNT(*) AS readings FROM readings GROUP BY 1""",
    }
    out = {k: using("readings", v) for k, v in out.items()}
    pf = "power_factor"
    out["G7_power_factor_by_meter"] = using(
        "light",
        f"""SELECT Meter_ID, {R(A(pf), 3)} AS avg_power_factor, {R(f'MAX({pf})', 3)} AS max_power_factor,
        {R(f'MIN({pf})', 3)} AS min_power_factor, COUNT(*) AS reading_count
        FROM light WHERE {pf} IS NOT NULL GROUP BY Meter_ID""",
    )
    out["G8_quarterly_totals"] = using(
        "star_readings",
        f"""SELECT strftime({TS}, '%Y') AS year, 'Q' || quarter({TS}) AS quarter,
        {R(S(P), 2)} AS quarterly_consumption, {R(A(P), 2)} AS avg_power_kw, COUNT(*) AS reading_count
        FROM star_readings GROUP BY 1, 2""",
    )
    out["G13_efficiency_ratings"] = using(
        "light",
        f"""SELECT Meter_ID, Zone_ID, COUNT(*) AS total_readings, {R(A(P), 2)} AS avg_power,
        {R(A('Reactive_Power_kW'), 2)} AS avg_reactive, {R(A(pf), 3)} AS avg_power_factor,
        {rating(A(pf), config.METER_PF_RATING)} AS efficiency_score
        FROM light WHERE {pf} IS NOT NULL GROUP BY Meter_ID, Zone_ID""",
    )
    return out


# --- trends and rankings --------------------------------------------------------------


def _next_later(table: str) -> str:
    return f"""WITH n AS (SELECT a.meter_id, a.ts, MIN(b.ts) AS nx FROM
        (SELECT row_number() OVER () AS id, meter_id, ts FROM {table}) a
        JOIN (SELECT DISTINCT meter_id, ts FROM {table}) b ON a.meter_id = b.meter_id AND b.ts > a.ts
        GROUP BY a.id, a.meter_id, a.ts), g AS (SELECT *, date_diff('minute', ts, nx) AS m FROM n)
        SELECT meter_id, meter_name, ts AS expected_time, nx AS actual_time, m AS time_gap_minutes,
        CASE WHEN m > 15 THEN 'Missing readings' ELSE 'Duplicate period' END AS gap_type
        FROM g LEFT JOIN meters USING (meter_id) WHERE m <> 15"""


def _trends() -> dict[str, str]:
    day = f"CAST({TS} AS DATE)"
    g_mean = f"(SELECT {A(P)} FROM readings)"
    ratio = f"({P} / Apparent_Power_kVA)"
    frame = "(PARTITION BY Meter_ID ORDER BY \"Timestamp\", _seq ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING)"
    cumulative = f"""SELECT Meter_ID, {TS}, {P},
        {SO(P, 'w')} AS cumulative_power,
        ROW_NUMBER() OVER w AS reading_number,
        {I(f'RANK() OVER (PARTITION BY Meter_ID ORDER BY {P} DESC NULLS LAST)')} AS power_rank_in_meter
        FROM readings WINDOW w AS (PARTITION BY Meter_ID ORDER BY {TS}, _seq
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
    spikes = f"""SELECT Meter_ID, {TS}, {P}, Zone_ID, {R('a', 9)} AS context_avg, {R(f'({P} - a)', 9)} AS deviation,
        CASE WHEN {P} > a + 2 * s THEN 'Spike' ELSE 'Normal' END AS classification
        FROM (SELECT *, AVG({P}) OVER {frame} AS a, STDDEV_SAMP({P}) OVER {frame} AS s FROM readings)"""
    out = {
        "B1_hourly_trend": f"""WITH h AS (SELECT date_trunc('hour', {TS}) AS hour_bucket, {A(P)} AS a, MAX({P}) AS hi,
            MIN({P}) AS lo, COUNT(*) AS n FROM readings GROUP BY 1)
            SELECT hour_bucket, a AS hourly_avg_power, hi AS hourly_max_power, lo AS hourly_min_power,
            n AS record_count, {R(WA('a', '(ORDER BY hour_bucket ROWS BETWEEN 24 PRECEDING AND CURRENT ROW)'), 2)}
            AS moving_avg_24h FROM h""",
        "B2_daily_by_weekday": f"""SELECT {day} AS consumption_date, {I(f'dayofweek({day})')} AS day_of_week,
            dayname({day}) AS day_name, {S(P)} AS daily_total_power, {A(P)} AS daily_avg_power,
            {R(f'STDDEV_POP({P})', 6)} AS daily_stddev, MAX({P}) AS peak_power, MIN({P}) AS min_power
            FROM readings GROUP BY {day}""",
        "B3_zone_ranking": f"""WITH z AS (SELECT Zone_ID, COUNT(*) AS n, {A(P)} AS a, MAX({P}) AS hi, MIN({P}) AS lo,
            STDDEV_POP({P}) AS s FROM readings GROUP BY 1)
            SELECT Zone_ID, n AS total_records, {R('a', 2)} AS avg_power_kw, {R('hi', 2)} AS peak_power_kw,
            {R('lo', 2)} AS min_power_kw, {R('s', 2)} AS stddev_power,
            {I('RANK() OVER (ORDER BY a DESC)')} AS consumption_rank,
            {R(f'(a / {g_mean} * 100.0)', 2)} AS percentage_of_avg FROM z""",
        "B4_top_meters_ranked": f"""WITH m AS (SELECT Meter_ID, Zone_ID, COUNT(*) AS n, {A(P)} AS a, MAX({P}) AS hi,
            {S(P)} AS s FROM readings GROUP BY 1, 2),
            q AS (SELECT {Q(P, 0.5)} AS p50, {Q(P, 0.75)} AS p75, {Q(P, 0.95)} AS p95 FROM readings)
            SELECT Meter_ID, Zone_ID, n AS record_count, {R('a', 3)} AS avg_power_kw, {R('hi', 3)} AS peak_power_kw,
            {R('s', 2)} AS total_power_kwh, {I('RANK() OVER (ORDER BY a DESC)')} AS meter_rank,
            {R(f'(a / {g_mean} * 100.0)', 2)} AS percentage_of_global_avg,
            CASE WHEN a > p95 THEN 'VeryHigh' WHEN a > p75 THEN 'High' WHEN a > p50 THEN 'Medium' ELSE 'Low' END
            AS consumption_category FROM m, q ORDER BY a DESC, Meter_ID, Zone_ID LIMIT 20""",
        "B5_peak_hours_ranked": f"""WITH h AS (SELECT hour({TS}) AS h, COUNT(*) AS n, {A(P)} AS a, MAX({P}) AS hi,
            {Q(P, 0.95)} AS p95 FROM readings GROUP BY 1), r AS (SELECT *, RANK() OVER (ORDER BY a DESC) AS k FROM h)
            SELECT {I('h')} AS hour_of_day, n AS record_count, {R('a', 2)} AS avg_power_during_hour,
            {R('hi', 2)} AS max_power_during_hour, {R('p95', 2)} AS p95_power, {I('k')} AS peak_rank,
            CASE WHEN k <= 5 THEN 'Peak' WHEN k BETWEEN 6 AND 12 THEN 'Mid-Peak' ELSE 'Off-Peak' END
            AS period_classification FROM r""",
        "B6_daily_change_by_meter": f"""WITH d AS (SELECT Meter_ID, date_trunc('day', {TS}) AS b, {S(P)} AS s
            FROM readings GROUP BY 1, 2), l AS (SELECT *, LAG(s) OVER w AS p, LEAD(s) OVER w AS x FROM d
            WINDOW w AS (PARTITION BY Meter_ID ORDER BY b))
            SELECT Meter_ID, CAST(b AS TIMESTAMP) AS day_bucket, {R('s', 2)} AS daily_consumption,
            {R('p', 2)} AS prev_day_consumption, {R(GROWTH('s', 'p'), 2)} AS percent_change,
            x AS next_day_consumption FROM l""",
        "B7_meter_iqr_anomalies": f"""WITH q AS (SELECT Meter_ID AS m, {Q(P, 0.25)} AS Q1, {Q(P, 0.75)} AS Q3
            FROM readings GROUP BY 1), b AS (SELECT *, Q3 - Q1 AS IQR, Q1 - 1.5 * (Q3 - Q1) AS LOWER_BOUND,
            Q3 + 1.5 * (Q3 - Q1) AS UPPER_BOUND FROM q)
            SELECT Meter_ID, {TS}, {P}, Zone_ID, Q1, Q3, IQR, LOWER_BOUND, UPPER_BOUND,
            CASE WHEN {P} < LOWER_BOUND THEN 'Below-Normal' WHEN {P} > UPPER_BOUND THEN 'Above-Normal'
            ELSE 'Normal' END AS status, abs({P} - Q3) AS distance_from_q3
            FROM readings JOIN b ON m = Meter_ID WHERE {P} < LOWER_BOUND OR {P} > UPPER_BOUND
            ORDER BY {TS} DESC, Meter_ID, _seq LIMIT 100""",
        "B8_poor_power_factor": f"""WITH m AS (SELECT Meter_ID, Zone_ID, {A(ratio)} AS a,
            {COUNT_IF(f'{ratio} < 0.85')} AS bad, COUNT(*) AS n
            FROM readings WHERE Apparent_Power_kVA > 0 GROUP BY 1, 2 HAVING {A(ratio)} < 0.90)
            SELECT Meter_ID, Zone_ID, {R('a', 3)} AS avg_power_factor, bad AS poor_pf_records, n AS total_records,
            {PCT('bad', 'n')} AS poor_pf_percentage, {I('RANK() OVER (ORDER BY a)')} AS low_pf_rank FROM m""",
        "B10_rolling_daily_averages": f"""WITH d AS (SELECT Meter_ID, date_trunc('day', {TS}) AS b, {A(P)} AS a
            FROM readings GROUP BY 1, 2)
            SELECT Meter_ID, CAST(b AS TIMESTAMP) AS day, {R('a', 2)} AS daily_avg,
            {R(WA('a', '(PARTITION BY Meter_ID ORDER BY b ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)'), 2)}
              AS avg_7day_rolling,
            {R(WA('a', '(PARTITION BY Meter_ID ORDER BY b ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)'), 2)}
              AS avg_30day_rolling,
            {R('STDDEV_SAMP(a) OVER (PARTITION BY Meter_ID ORDER BY b ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 2)}
              AS stddev_7day FROM d""",
        "B11_cumulative_by_meter": f"{cumulative} ORDER BY Meter_ID, {TS} DESC, _seq DESC LIMIT 1000",
        "B11_cumulative_by_meter_all": cumulative,
        "B12_zone_distribution": f"""WITH t AS (SELECT Zone_ID AS z, {R(P, 1)} AS t, COUNT(*) AS n FROM readings
            WHERE {P} IS NOT NULL GROUP BY 1, 2), o AS (SELECT z, t AS mode FROM (SELECT *,
            ROW_NUMBER() OVER (PARTITION BY z ORDER BY n DESC, t) AS k FROM t) WHERE k = 1),
            s AS (SELECT Zone_ID, COUNT(*) AS n, {A(P)} AS a, {Q(P, 0.5)} AS q50, STDDEV_SAMP({P}) AS sd,
            {Q(P, 0.25)} AS q25, {Q(P, 0.75)} AS q75, {Q(P, 0.05)} AS q05, {Q(P, 0.95)} AS q95,
            MIN({P}) AS lo, MAX({P}) AS hi FROM readings GROUP BY 1)
            SELECT Zone_ID, n AS record_count, {R('a', 2)} AS mean, {R('q50', 2)} AS median, {R('mode', 2)} AS mode,
            {R('sd', 2)} AS stddev, {R('q25', 2)} AS q1, {R('q75', 2)} AS q3, {R('q05', 2)} AS p5,
            {R('q95', 2)} AS p95, lo AS min_val, hi AS max_val, {R('(hi - lo)', 2)} AS range
            FROM s LEFT JOIN o ON z = Zone_ID""",
        "B13_zone_hour_demand": f"""WITH z AS (SELECT Zone_ID, hour({TS}) AS h, COUNT(*) AS n, {A(P)} AS a,
            MAX({P}) AS hi, MIN({P}) AS lo FROM readings GROUP BY 1, 2)
            SELECT Zone_ID, {I('h')} AS hour, n AS occurrence_count, {R('a', 2)} AS avg_power,
            {R('hi', 2)} AS peak_power, {R('lo', 2)} AS min_power,
            {I('RANK() OVER (PARTITION BY Zone_ID ORDER BY a DESC)')} AS peak_rank_in_zone,
            {I('DENSE_RANK() OVER (ORDER BY a DESC)')} AS global_peak_rank FROM z""",
        "B14_hourly_volatility": f"""WITH g AS (SELECT Meter_ID, Zone_ID, date_trunc('hour', {TS}) AS hour_bucket,
            COUNT(*) AS reading_count, {A(P)} AS a, STDDEV_SAMP({P}) AS s, MAX({P}) - MIN({P}) AS range
            FROM readings GROUP BY 1, 2, 3)
            SELECT Meter_ID, Zone_ID, hour_bucket, reading_count, {R('a', 2)} AS hourly_avg,
            {R('s', 2)} AS hourly_stddev, {R('(s / NULLIF(a, 0))', 2)} AS coefficient_of_variation, range
            FROM g WHERE s / NULLIF(a, 0) > 0.5""",
        "B15_top_hours_by_zone": f"""WITH g AS (SELECT Zone_ID, {I(f'hour({TS})')} AS hour, {R(S(P), 2)} AS total_power_hour,
            COUNT(*) AS meter_count FROM readings GROUP BY Zone_ID, hour({TS})), r AS (SELECT *,
            {I('ROW_NUMBER() OVER (PARTITION BY Zone_ID ORDER BY total_power_hour DESC, hour)')} AS hour_rank_in_zone,
            {I('RANK() OVER (ORDER BY total_power_hour DESC)')} AS global_hour_rank FROM g)
            SELECT * FROM r WHERE hour_rank_in_zone <= 5""",
        "B17_efficiency_by_meter": f"""WITH m AS (SELECT Meter_ID, Zone_ID, {A(P)} AS a FROM readings GROUP BY 1, 2),
            s AS (SELECT *, 100.0 * (1.0 - a / (SELECT MAX({P}) FROM readings)) AS e FROM m)
            SELECT Meter_ID, Zone_ID, {R('a', 2)} AS avg_consumption, {R('e', 2)} AS efficiency_score,
            {rating('e', config.EFFICIENCY_RATING)} AS efficiency_rating FROM s""",
        "B18_context_spikes": f"{spikes} ORDER BY Meter_ID, {TS} DESC, _seq DESC LIMIT 500",
        "B18_context_spikes_all": spikes,
    }
    out = {k: using("readings", v) for k, v in out.items()}
    out["B9_quarterly_growth"] = using(
        "star_readings",
        f"""WITH g AS (SELECT quarter({TS}) AS q, year({TS}) AS y, Zone_ID, COUNT(*) AS n, {A(P)} AS a, {S(P)} AS s
        FROM star_readings GROUP BY 1, 2, 3),
        l AS (SELECT *, LAG(s) OVER (PARTITION BY Zone_ID ORDER BY y, q) AS p FROM g)
        SELECT {I('q')} AS quarter, {I('y')} AS year, Zone_ID, n AS record_count, {R('a', 2)} AS quarterly_avg,
        {R('s', 2)} AS quarterly_total, {R(GROWTH('s', 'p'), 2)} AS yoq_growth_rate FROM l""",
    )
    out["B16_month_over_month"] = using(
        "star_readings",
        f"""WITH g AS (SELECT Meter_ID, date_trunc('month', {TS}) AS m, {A(P)} AS a, {S(P)} AS s
        FROM star_readings GROUP BY 1, 2),
        l AS (SELECT *, LAG(s) OVER (PARTITION BY Meter_ID ORDER BY m) AS p FROM g)
        SELECT Meter_ID, CAST(m AS TIMESTAMP) AS month, {R('s', 2)} AS monthly_consumption, {R('a', 2)} AS monthly_avg,
        {R('p', 2)} AS prev_month_consumption, {R(GROWTH('s', 'p'), 2)} AS mom_growth_percent FROM l""",
    )
    return out


# --- star-schema reports ---------------------------------------------------------------

V = "active_power_kw"
ANOM = "COUNT(CASE WHEN is_anomaly = 1 THEN 1 END)"


def _reports() -> dict[str, str]:
    def names(meters="star_meters", zones="star_zones", zone=True, meter=True):
        out = f" LEFT JOIN {meters} USING (meter_id)" if meter else ""
        return out + (f" LEFT JOIN {zones} USING (zone_id)" if zone else "")

    out = {
        "D1_1_daily_by_meter": using(
            "star_fact star_meters star_zones",
            f"""WITH g AS (SELECT CAST(ts AS DATE) AS reading_date, meter_id, zone_id, {S(V)} AS total_consumption_kwh,
            {A(V)} AS avg_power_kw, MAX({V}) AS max_power_kw, MIN({V}) AS min_power_kw,
            {R(f'STDDEV_SAMP({V})', 6)} AS stddev_power_kw, COUNT(*) AS reading_count FROM star_fact GROUP BY 1, 2, 3)
            SELECT reading_date, meter_id, meter_name, zone_id, zone_name, total_consumption_kwh, avg_power_kw,
            max_power_kw, min_power_kw, stddev_power_kw, reading_count FROM g{names()}""",
        ),
        "D1_2_monthly_trend": using(
            "star_fact star_meters star_zones",
            f"""WITH g AS (SELECT year, month, meter_id, zone_id, {S(V)} AS monthly_consumption_kwh,
            {A(V)} AS avg_power_kw, COUNT(DISTINCT CAST(ts AS DATE)) AS days_in_month FROM star_fact
            WHERE month IS NOT NULL AND year IS NOT NULL GROUP BY 1, 2, 3, 4)
            SELECT {I('year')} AS year, {I('month')} AS month, meter_id, meter_name, zone_id, zone_name,
            monthly_consumption_kwh, avg_power_kw, days_in_month,
            monthly_consumption_kwh / NULLIF(days_in_month, 0) AS avg_daily_kwh FROM g{names()}""",
        ),
        "D1_3_year_over_year": using(
            "star_fact star_zones",
            f"""WITH g AS (SELECT {I('year')} AS year, {I('month')} AS month, zone_id, {S(V)} AS monthly_kwh
            FROM star_fact GROUP BY 1, 2, 3)
            SELECT year, month, zone_id, zone_name, monthly_kwh FROM g{names(meter=False)}""",
        ),
        "D2_1_peak_by_season": using(
            "star_fact",
            f"""SELECT {I('hour_of_day')} AS hour_of_day, season, COUNT(*) AS reading_count, {A(V)} AS avg_load_kw,
            MAX({V}) AS peak_load_kw, MIN({V}) AS min_load_kw, {R(f'STDDEV_SAMP({V})', 6)} AS stddev_load_kw,
            {ANOM} AS anomaly_count, {PCT(ANOM, 'COUNT(*)')} AS anomaly_percentage
            FROM star_fact WHERE hour_of_day IS NOT NULL GROUP BY hour_of_day, season""",
        ),
        "D2_2_peak_share_by_meter": using(
            "fact meters",
            f"""WITH g AS (SELECT meter_id, zone_id, peak_hour_flag AS f, COUNT(*) AS reading_count, {S(V)} AS total_kwh,
            {A(V)} AS avg_power_kw FROM fact GROUP BY 1, 2, 3),
            t AS (SELECT meter_id, {S(V)} AS whole FROM fact GROUP BY 1)
            SELECT meter_id, meter_name, zone_id, CASE WHEN f = 1 THEN 'Peak' ELSE 'Off-Peak' END AS period_type,
            reading_count, total_kwh, avg_power_kw, {PCT('total_kwh', 'whole')} AS consumption_percentage
            FROM g LEFT JOIN t USING (meter_id) LEFT JOIN meters USING (meter_id)""",
        ),
        "D2_3_load_profile": using(
            "fact",
            f"""SELECT {I('hour_of_day')} AS hour_of_day, {I('day_of_week')} AS day_of_week, COUNT(*) AS reading_count,
            {A(V)} AS avg_power_kw, MAX({V}) AS max_power_kw, MIN({V}) AS min_power_kw FROM fact
            WHERE hour_of_day IS NOT NULL AND day_of_week IS NOT NULL GROUP BY hour_of_day, day_of_week""",
        ),
        "D3_1_zone_summary": using("fact zones", _zone_summary("SELECT * FROM s")),
        "D3_2_zone_by_hour": using(
            "fact zones",
            f"""WITH g AS (SELECT zone_id, {I('hour_of_day')} AS hour_of_day, COUNT(DISTINCT meter_id) AS meter_count,
            COUNT(*) AS reading_count, {S(V)} AS total_consumption_kwh, {A(V)} AS avg_power_kw,
            MAX({V}) AS peak_power_kw FROM fact WHERE hour_of_day IS NOT NULL GROUP BY zone_id, hour_of_day)
            SELECT zone_id, zone_name, hour_of_day, meter_count, reading_count, total_consumption_kwh, avg_power_kw,
            peak_power_kw FROM g LEFT JOIN zones USING (zone_id)""",
        ),
        "D3_3_zone_comparison": using(
            "fact zones",
            _zone_summary(
                f"""SELECT zone_id, zone_name, meter_count, total_consumption_kwh,
                {R('total_consumption_kwh', 2)} AS avg_consumption_per_meter,
                CASE WHEN total_consumption_kwh > (SELECT {A('total_consumption_kwh')} FROM s) THEN 'High'
                ELSE 'Low' END AS consumption_level,
                total_consumption_kwh / NULLIF(meter_count, 0) AS consumption_per_meter FROM s"""
            ),
        ),
        "D4_4_data_quality_summary": using(
            "flagged_fact",
            f"""SELECT COUNT(*) AS total_readings, {COUNT_IF('voltage_v IS NULL')} AS null_voltage_count,
            {COUNT_IF('current_a IS NULL')} AS null_current_count, {ANOM} AS anomaly_count,
            {PCT(ANOM, 'COUNT(*)')} AS overall_anomaly_percentage FROM flagged_fact""",
        ),
        "D5_1_load_category_distribution": using(
            "star_fact",
            f"""SELECT load_category, COUNT(*) AS reading_count,
            {PCT('COUNT(*)', '(SELECT COUNT(*) FROM star_fact)')} AS percentage_of_total, {A(V)} AS avg_power_kw,
            MAX({V}) AS max_power_kw, MIN({V}) AS min_power_kw FROM star_fact
            WHERE load_category IS NOT NULL GROUP BY load_category""",
        ),
        "D5_2_load_category_by_meter": using(
            "star_fact star_meters",
            f"""WITH t AS (SELECT meter_id, COUNT(*) AS whole FROM star_fact GROUP BY 1), g AS (SELECT meter_id,
            load_category, COUNT(*) AS reading_count FROM star_fact WHERE load_category IS NOT NULL GROUP BY 1, 2)
            SELECT meter_id, meter_name, load_category, reading_count, {PCT('reading_count', 'whole')} AS percentage
            FROM g LEFT JOIN t USING (meter_id) LEFT JOIN star_meters USING (meter_id)""",
        ),
        "D6_1_power_factor_by_day": using(
            "fact",
            f"""SELECT CAST(ts AS DATE) AS reading_date, zone_id, {R(A('power_factor'), 3)} AS avg_power_factor,
            {R('MIN(power_factor)', 3)} AS min_power_factor, {R('MAX(power_factor)', 3)} AS max_power_factor,
            COUNT(*) AS reading_count, {COUNT_IF('power_factor < 0.95')} AS low_power_factor_count
            FROM fact GROUP BY 1, 2""",
        ),
        "D6_2_frequency_stability": using(
            "fact",
            f"""SELECT CAST(ts AS DATE) AS reading_date, zone_id, {R(A('frequency_hz'), 3)} AS avg_frequency_hz,
            {R('STDDEV_SAMP(frequency_hz)', 3)} AS stddev_frequency, {R('MIN(frequency_hz)', 3)} AS min_frequency_hz,
            {R('MAX(frequency_hz)', 3)} AS max_frequency_hz,
            {COUNT_IF('abs(frequency_hz - CAST(50 AS DOUBLE)) > CAST(0.5 AS DOUBLE)')} AS out_of_spec_count
            FROM fact GROUP BY 1, 2""",
        ),
        "D6_3_voltage_stability": using(
            "fact",
            f"""SELECT zone_id, {R(A('voltage_v'), 2)} AS avg_voltage_v, {R('STDDEV_SAMP(voltage_v)', 2)} AS stddev_voltage,
            {R('MIN(voltage_v)', 2)} AS min_voltage_v, {R('MAX(voltage_v)', 2)} AS max_voltage_v,
            {COUNT_IF('voltage_v < 190 OR voltage_v > 250')} AS out_of_spec_count, COUNT(*) AS total_readings
            FROM fact GROUP BY 1""",
        ),
        "D7_1_top_meters": using(
            "fact meters zones",
            f"""WITH g AS (SELECT meter_id, zone_id, {S(V)} AS total_consumption_kwh, {A(V)} AS avg_power_kw,
            COUNT(*) AS reading_count FROM fact GROUP BY 1, 2
            ORDER BY total_consumption_kwh DESC NULLS LAST, meter_id, zone_id LIMIT 10)
            SELECT meter_id, meter_name, zone_id, zone_name, total_consumption_kwh, avg_power_kw, reading_count
            FROM g{names('meters', 'zones')}""",
        ),
        "D7_2_bottom_meters": using(
            "fact meters",
            f"""WITH g AS (SELECT meter_id, zone_id, {S(V)} AS total_consumption_kwh, {A(V)} AS avg_power_kw,
            COUNT(*) AS reading_count FROM fact GROUP BY 1, 2
            ORDER BY total_consumption_kwh ASC NULLS FIRST, meter_id, zone_id LIMIT 10)
            SELECT meter_id, meter_name, zone_id, total_consumption_kwh, avg_power_kw, reading_count
            FROM g{names('meters', zone=False)}""",
        ),
        "D7_3_rank_in_zone": using(
            "fact meters",
            f"""WITH g AS (SELECT zone_id, meter_id, {S(V)} AS zone_meter_consumption_kwh FROM fact GROUP BY 1, 2)
            SELECT zone_id, meter_id, meter_name, zone_meter_consumption_kwh,
            {N('ROW_NUMBER() OVER (PARTITION BY zone_id ORDER BY zone_meter_consumption_kwh DESC NULLS LAST, meter_id)')}
            AS rank_in_zone FROM g{names('meters', zone=False)}""",
        ),
        "D8_1_seasonal_totals": using(
            "star_fact",
            f"""SELECT season, COUNT(*) AS reading_count, {S(V)} AS seasonal_total_kwh, {A(V)} AS seasonal_avg_power_kw,
            MAX({V}) AS seasonal_peak_power_kw, {R(A('outdoor_temp_c'), 2)} AS avg_outdoor_temp_c
            FROM star_fact WHERE season IS NOT NULL GROUP BY season""",
        ),
        "D8_2_weekday_totals": using(
            "fact",
            f"""SELECT {I('day_of_week')} AS day_of_week, CASE day_of_week WHEN 0 THEN 'Monday' WHEN 1 THEN 'Tuesday'
            WHEN 2 THEN 'Wednesday' WHEN 3 THEN 'Thursday' WHEN 4 THEN 'Friday' WHEN 5 THEN 'Saturday'
            WHEN 6 THEN 'Sunday' END AS day_name, COUNT(*) AS reading_count, {S(V)} AS daily_total_kwh,
            {A(V)} AS daily_avg_power_kw FROM fact WHERE day_of_week IS NOT NULL GROUP BY day_of_week""",
        ),
        "D9_1_submeter_shares": using(
            "fact meters",
            f"""WITH g AS (SELECT meter_id, zone_id, {S(V)} AS total_consumption_kwh,
            {S('sub_meter_kitchen')} AS kitchen_consumption_kwh, {S('sub_meter_hvac')} AS hvac_consumption_kwh
            FROM fact GROUP BY 1, 2)
            SELECT meter_id, meter_name, zone_id, total_consumption_kwh, kitchen_consumption_kwh, hvac_consumption_kwh,
            {PCT('kitchen_consumption_kwh', 'total_consumption_kwh')} AS kitchen_percentage,
            {PCT('hvac_consumption_kwh', 'total_consumption_kwh')} AS hvac_percentage
            FROM g{names('meters', zone=False)}""",
        ),
        "D10_1_meter_vs_zone": using(
            "fact meters",
            f"""WITH g AS (SELECT meter_id, zone_id, {A(V)} AS a FROM fact GROUP BY 1, 2),
            z AS (SELECT zone_id, {A(V)} AS za FROM fact WHERE zone_id IS NOT NULL GROUP BY 1)
            SELECT meter_id, meter_name, zone_id, a AS meter_avg_power_kw, za AS zone_avg_power_kw,
            {R('(a - za)', 4)} AS variance_kw,
            CASE WHEN a > za THEN 'Above Average' ELSE 'Below Average' END AS performance_category
            FROM g LEFT JOIN z USING (zone_id) LEFT JOIN meters USING (meter_id)""",
        ),
    }
    by_meter = f"""WITH g AS (SELECT meter_id, zone_id, COUNT(*) AS total_readings, {ANOM} AS anomaly_count,
        {PCT(ANOM, 'COUNT(*)')} AS anomaly_percentage FROM star_fact GROUP BY 1, 2 {{tail}})
        SELECT meter_id, meter_name, zone_id, total_readings, anomaly_count, anomaly_percentage
        FROM g LEFT JOIN star_meters USING (meter_id)"""
    by_day = f"""SELECT CAST(ts AS DATE) AS reading_date, COUNT(*) AS total_readings, {ANOM} AS anomaly_count,
        {PCT(ANOM, 'COUNT(*)')} AS anomaly_percentage FROM star_fact GROUP BY 1"""
    top = "ORDER BY anomaly_count DESC, meter_id, zone_id LIMIT {n}"
    need = "star_fact star_meters"
    for k in ("D4_1_anomalies_by_meter", "Q5_1_anomaly_summary_by_meter"):
        out[k] = using(need, by_meter.format(tail=""))
    for k in ("D4_2_anomalies_by_day", "Q5_2_anomalies_by_date"):
        out[k] = using("star_fact", by_day)
    out["D4_3_top_anomalous_meters"] = using(need, by_meter.format(tail=top.format(n=10)))
    out["Q5_3_high_anomaly_meters"] = using(need, by_meter.format(tail=top.format(n=20)))
    return out


def _zone_summary(tail: str) -> str:
    return f"""WITH g AS (SELECT zone_id, COUNT(DISTINCT meter_id) AS meter_count, COUNT(*) AS total_readings,
        {S(V)} AS total_consumption_kwh, {A(V)} AS avg_power_kw, MAX({V}) AS peak_power_kw,
        {R(A('power_factor'), 3)} AS avg_power_factor, {R(A('frequency_hz'), 2)} AS avg_frequency_hz
        FROM fact GROUP BY 1), s AS (SELECT zone_id, zone_name, district, meter_count, total_readings,
        total_consumption_kwh, avg_power_kw, peak_power_kw, avg_power_factor, avg_frequency_hz
        FROM g LEFT JOIN zones USING (zone_id)) {tail}"""


# --- audits ------------------------------------------------------------------------------


def _audits() -> dict[str, str]:
    from meterlake.queries.audit import NULL_COLUMNS, RANGES, VIOLATIONS

    sql_name = {"timestamp": "ts"}
    nulls = " UNION ALL ".join(
        f"""SELECT '{n}' AS column_name, {COUNT_IF(f'{sql_name.get(c, c)} IS NULL')} AS null_count,
        COUNT(*) AS total_count, {PCT(COUNT_IF(f'{sql_name.get(c, c)} IS NULL'), 'COUNT(*)')} AS null_percentage
        FROM fact"""
        for n, c in NULL_COLUMNS.items()
    )
    ranges = " UNION ALL ".join(
        f"""SELECT '{n}' AS measurement, {COUNT_IF(f'{c} < {lo} OR {c} > {hi}')} AS out_of_range_count,
        COUNT(*) AS total_count, {PCT(COUNT_IF(f'{c} < {lo} OR {c} > {hi}'), 'COUNT(*)')} AS out_of_range_percentage,
        {R(f'MIN({c})', k)} AS actual_min, {R(f'MAX({c})', k)} AS actual_max, '{label}' AS expected_range FROM fact"""
        for n, (c, lo, hi, k, label) in RANGES.items()
    )
    kind = "CASE " + " ".join(f"WHEN {c} < {lo} OR {c} > {hi} THEN '{t}'" for c, lo, hi, t in VIOLATIONS) + " END"
    gone = "(voltage_v IS NULL OR current_a IS NULL OR active_power_kw IS NULL)"
    bad3 = " OR ".join(f"{c} < {lo} OR {c} > {hi}" for c, lo, hi, _ in VIOLATIONS[:3])
    calc = "sqrt(active_power_kw * active_power_kw + reactive_power_kw * reactive_power_kw)"
    return {
        "Q1_1_null_counts": using("fact", nulls),
        "Q1_2_meters_with_missing": using(
            "fact meters",
            f"""WITH g AS (SELECT meter_id, COUNT(*) AS total_readings, {COUNT_IF('voltage_v IS NULL')} AS voltage_nulls,
            {COUNT_IF('current_a IS NULL')} AS current_nulls, {COUNT_IF('active_power_kw IS NULL')} AS power_nulls,
            {PCT(COUNT_IF(gone), 'COUNT(*)')} AS overall_null_percentage FROM fact GROUP BY 1
            HAVING {COUNT_IF(gone)} > 0)
            SELECT meter_id, meter_name, total_readings, voltage_nulls, current_nulls, power_nulls,
            overall_null_percentage FROM g LEFT JOIN meters USING (meter_id)""",
        ),
        "Q2_1_duplicate_readings": using(
            "dup_fact",
            """SELECT ts AS timestamp, meter_id, zone_id, COUNT(*) AS duplicate_count FROM dup_fact
            GROUP BY 1, 2, 3 HAVING COUNT(*) > 1""",
        ),
        "Q2_2_duplicate_summary": using(
            "dup_fact",
            f"""SELECT COUNT(*) AS total_readings, COUNT(DISTINCT reading_id) AS unique_reading_ids,
            COUNT(*) - COUNT(DISTINCT reading_id) AS duplicate_records,
            {PCT('(COUNT(*) - COUNT(DISTINCT reading_id))', 'COUNT(*)')} AS duplicate_percentage FROM dup_fact""",
        ),
        "Q2_3_most_duplicated_meters": using(
            "dup_fact meters",
            """WITH g AS (SELECT meter_id, COUNT(*) AS total_records, COUNT(DISTINCT CAST(ts AS DATE)) AS unique_dates,
            COUNT(*) - COUNT(DISTINCT (CAST(ts AS DATE), hour_of_day)) AS duplicate_records FROM dup_fact GROUP BY 1
            ORDER BY duplicate_records DESC, meter_id LIMIT 10)
            SELECT meter_id, meter_name, total_records, unique_dates, duplicate_records
            FROM g LEFT JOIN meters USING (meter_id)""",
        ),
        "Q3_1_out_of_range_summary": using("fact", ranges),
        "Q3_2_out_of_range_readings": using(
            "fact",
            f"""SELECT reading_id, ts AS timestamp, meter_id, zone_id, voltage_v, current_a, active_power_kw,
            frequency_hz, {kind} AS violation_type FROM fact WHERE {kind} IS NOT NULL
            ORDER BY ts DESC, reading_id DESC LIMIT 100""",
        ),
        "Q3_3_dead_voltage": using(
            "fact",
            f"""SELECT COUNT(*) AS zero_voltage_nonzero_current_records,
            {PCT('COUNT(*)', '(SELECT COUNT(*) FROM fact)')} AS percentage_of_total
            FROM fact WHERE voltage_v = 0 AND current_a > 0""",
        ),
        "Q4_1_apparent_power_mismatch": using(
            "fact",
            f"""SELECT reading_id, ts AS timestamp, meter_id, active_power_kw, reactive_power_kw, apparent_power_kva,
            {R(calc, 3)} AS calculated_apparent_power, {R(f'abs(apparent_power_kva - {calc})', 3)} AS variance
            FROM fact WHERE abs(apparent_power_kva - {calc}) > 0.1 ORDER BY variance DESC, reading_id LIMIT 100""",
        ),
        "Q4_2_invalid_power_factor": using(
            "raw_fact",
            f"""SELECT COUNT(*) AS power_factor_invalid_count,
            {PCT('COUNT(*)', '(SELECT COUNT(*) FROM raw_fact)')} AS percentage_of_total
            FROM raw_fact WHERE power_factor < 0 OR power_factor > 1""",
        ),
        "Q4_3_reading_gaps": using("fact meters", _next_later("fact")),
        "Q4_3_reading_gaps_dup": using("dup_fact meters", _next_later("dup_fact")),
        "Q6_1_quality_overview": using(
            "flagged_fact meters zones",
            f"""SELECT COUNT(*) AS total_records, (SELECT COUNT(*) FROM meters) AS total_meters,
            (SELECT COUNT(*) FROM zones) AS total_zones, COUNT(DISTINCT CAST(ts AS DATE)) AS days_covered,
            {PCT('(COUNT(*) - COUNT(DISTINCT reading_id))', 'COUNT(*)')} AS duplicate_percentage,
            {PCT(COUNT_IF(gone), 'COUNT(*)')} AS null_percentage, {PCT(ANOM, 'COUNT(*)')} AS anomaly_percentage,
            {PCT('(COUNT(*) - ' + COUNT_IF('is_anomaly = 1 OR voltage_v IS NULL OR current_a IS NULL') + ')', 'COUNT(*)')}
            AS overall_quality_score_percentage FROM flagged_fact""",
        ),
        "Q6_2_daily_quality": using(
            "flagged_fact",
            f"""SELECT CAST(ts AS DATE) AS reading_date, COUNT(*) AS total_readings, {COUNT_IF(gone)} AS null_records,
            {ANOM} AS anomaly_records, {COUNT_IF(bad3)} AS out_of_range_records,
            {PCT(f'(COUNT(*) - {COUNT_IF(gone)} - {ANOM})', 'COUNT(*)')} AS daily_quality_score
            FROM flagged_fact GROUP BY 1""",
        ),
    }


def all_sql() -> dict[str, str]:
    from checks import oracles_operators

    return {
        **_flat(),
        **_trends(),
        **_reports(),
        **_audits(),
        **oracles_operators.all_sql(),
    }


TWO_PI = 2 * math.pi
ALL_MEASURES = MEASURES
