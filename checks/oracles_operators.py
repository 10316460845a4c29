"""SQL for cleaning, features, validation, aggregates, analyses and chart data."""

from __future__ import annotations

from checks.oracles import (
    ANOM,
    COUNT_IF,
    P,
    PCT,
    TS,
    V,
    A,
    I,
    N,
    Q,
    R,
    S,
    bands,
    monday0,
    peak,
    rating,
    seasons,
    using,
)
from meterlake import config
from meterlake.schema import MEASURES

ALL = ["_seq", "Timestamp", "Meter_ID", "Zone_ID", *MEASURES]
DATA = ALL[1:]
DATA_SQL = ", ".join(f'"{c}"' for c in DATA)
TEXTS = ("Meter_ID", "Zone_ID")


def _fences(columns, source: str) -> str:
    """One row with lower and upper fence per column."""
    q = ", ".join(f"{Q(c, 0.25)} AS a_{c}, {Q(c, 0.75)} AS b_{c}" for c in columns)
    f = ", ".join(
        f"a_{c}, b_{c}, a_{c} - 1.5 * (b_{c} - a_{c}) AS lo_{c}, b_{c} + 1.5 * (b_{c} - a_{c}) AS hi_{c}"
        for c in columns
    )
    return f"(SELECT {f} FROM (SELECT {q} FROM {source}))"


def _outside(c: str) -> str:
    return f"({c} < lo_{c} OR {c} > hi_{c})"


def _flag(columns) -> str:
    return f"CASE WHEN {' OR '.join(_outside(c) for c in columns)} THEN 1 ELSE 0 END"


# --- cleaning -------------------------------------------------------------------

FIRST = f"""first_rows AS (SELECT {', '.join(f'"{c}"' for c in ALL)} FROM (SELECT *,
    ROW_NUMBER() OVER (PARTITION BY Meter_ID, {TS} ORDER BY _seq) AS k FROM dup) WHERE k = 1)"""


def _filled() -> str:
    fills = ", ".join(
        f"COALESCE(LAST_VALUE({c} IGNORE NULLS) OVER up, FIRST_VALUE({c} IGNORE NULLS) OVER down) AS {c}"
        for c in MEASURES
    )
    meds = ", ".join(f"{Q(c, 0.5)} AS m_{c}" for c in MEASURES)
    final = ", ".join(f"COALESCE({c}, m_{c}) AS {c}" for c in MEASURES)
    return f"""{FIRST}, runs AS (SELECT _seq, {TS}, Meter_ID, Zone_ID, {fills} FROM first_rows
        WINDOW up AS (PARTITION BY Meter_ID ORDER BY {TS}, _seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        down AS (PARTITION BY Meter_ID ORDER BY {TS}, _seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        filled AS (SELECT _seq, {TS}, Meter_ID, Zone_ID, {final} FROM runs, (SELECT {meds} FROM runs))"""


def _steps():
    alive, out = [], []
    for c, (lo, hi) in config.VALID_RANGES.items():
        drops = lo >= 0 and c in config.NON_NEGATIVE
        before = " AND ".join(alive) or "TRUE"
        keep = f"COALESCE({c} >= {lo}, FALSE)"
        out.append((c, lo, hi, before, keep if drops else None))
        if drops:
            alive.append(keep)
    return out, " AND ".join(alive)


def _repaired(source: str, mode: str) -> str:
    steps, keep = _steps()
    counts, cols = [], []
    for c, lo, hi, before, k in steps:
        clipped = f"CASE WHEN {c} < {lo} THEN CAST({lo} AS DOUBLE) WHEN {c} > {hi} THEN CAST({hi} AS DOUBLE) ELSE {c} END"
        if k and mode == "compat":
            counts.append(f"{COUNT_IF(f'({before}) AND NOT {k}')} AS d_{c}")
            cols.append(f"CASE WHEN d_{c} > 0 THEN {c} ELSE {clipped} END AS {c}")
        else:
            cols.append(f"{clipped} AS {c}")
    extra = f", (SELECT {', '.join(counts)} FROM {source})" if counts else ""
    return f"SELECT _seq, {TS}, Meter_ID, Zone_ID, {', '.join(cols)} FROM {source}{extra} WHERE {keep}"


def _repair_report() -> str:
    steps, _ = _steps()
    rows = []
    for c, lo, hi, before, k in steps:
        gone = f"NOT {k}" if k else "FALSE"
        rows.append(
            f"""SELECT '{c}' AS column_name, {COUNT_IF(f'({before}) AND {gone}')} AS d,
            {COUNT_IF(f'({before}) AND NOT ({gone}) AND {c} < {lo}')} AS l,
            {COUNT_IF(f'({before}) AND NOT ({gone}) AND {c} > {hi}')} AS h FROM readings"""
        )
    return f"""WITH r AS ({' UNION ALL '.join(rows)})
        SELECT column_name, CASE WHEN d > 0 THEN 'removed_negative' ELSE 'clipped' END AS action, d AS rows_removed,
        CASE WHEN d > 0 THEN 0 ELSE l END AS clipped_low, CASE WHEN d > 0 THEN 0 ELSE h END AS clipped_high
        FROM r WHERE d > 0 OR l > 0 OR h > 0"""


def _cleaned(mode: str = "compat") -> str:
    return f"""{_filled()}, repaired AS ({_repaired('filled', mode)}), cleaned AS (SELECT
        {', '.join(f'"{c}"' for c in ALL)}, {_flag(MEASURES)} AS is_anomaly
        FROM repaired, {_fences(MEASURES, 'repaired')})"""


def _simple() -> str:
    meds = ", ".join(f"{Q(c, 0.5)} AS m_{c}" for c in MEASURES)
    modes = ", ".join(
        f"(SELECT {c} FROM dup WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1) AS t_{c}"
        for c in TEXTS
    )
    cols = ", ".join(
        [TS]
        + [f"COALESCE({c}, t_{c}) AS {c}" for c in TEXTS]
        + [f"COALESCE({c}, m_{c}) AS {c}" for c in MEASURES]
    )
    return f"""uniq AS (SELECT DISTINCT {cols} FROM dup, (SELECT {meds} FROM dup), (SELECT {modes})),
        simple AS (SELECT {DATA_SQL}, {_flag(MEASURES)} AS is_outlier FROM uniq, {_fences(MEASURES, 'uniq')})"""


def _nulls(columns) -> str:
    return "(" + " + ".join(COUNT_IF(f'"{c}" IS NULL') for c in columns) + ")"


def _cleaning() -> dict[str, str]:
    mismatch = (
        "abs(Apparent_Power_kVA - sqrt(Active_Power_kW * Active_Power_kW + "
        "Reactive_Power_kW * Reactive_Power_kW)) > 0.1"
    )
    missing = " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, (SELECT {COUNT_IF(f'{c} IS NULL')} FROM first_rows) AS initial_missing,
        (SELECT {COUNT_IF(f'{c} IS NULL')} FROM filled) AS final_missing,
        (SELECT {R(f"(CAST({COUNT_IF(f'{c} IS NULL')} AS DOUBLE) * 100.0 / COUNT(*))", 6)} FROM first_rows)
        AS missing_percentage"""
        for c in MEASURES
    )
    loose = []
    for c, (lo, hi) in config.LOOSE_RANGES.items():
        parts = [f"{c} < {lo}"] if lo is not None else []
        parts += [f"{c} > {hi}"] if hi is not None else []
        loose.append(f"SELECT '{c}' AS column_name, {COUNT_IF(' OR '.join(parts))} AS row_count FROM readings")
    counts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {COUNT_IF(_outside(c))} AS outliers FROM readings, f" for c in MEASURES
    )
    return {
        "C1_keep_first": using("dup", f"WITH {FIRST} SELECT * FROM first_rows"),
        "C2_fill_missing": using("dup", f"WITH {_filled()} SELECT * FROM filled"),
        "C2_missing_report": using(
            "dup", f"WITH {_filled()} SELECT * FROM ({missing}) WHERE initial_missing > 0"
        ),
        "C3_repair_compat": using("readings", _repaired("readings", "compat")),
        "C3_repair_clip_always": using("readings", _repaired("readings", "clip_always")),
        "C3_repair_report": using("readings", _repair_report()),
        "C4_logical_inconsistencies": using(
            "readings",
            f"""SELECT * FROM (SELECT 'apparent_power_mismatch' AS rule, {COUNT_IF(mismatch)} AS row_count FROM readings
            UNION ALL SELECT 'zero_voltage_with_current', {COUNT_IF('Voltage_V = 0 AND Current_A > 0')} FROM readings)
            WHERE row_count > 0""",
        ),
        "C5_flag_outliers": using(
            "readings",
            f"SELECT _seq, {_flag(MEASURES)} AS is_anomaly FROM readings, {_fences(MEASURES, 'readings')}",
        ),
        "C5_outlier_counts": using(
            "readings", f"WITH f AS (SELECT * FROM {_fences(MEASURES, 'readings')}) {counts}"
        ),
        "C6_clean_readings": using("dup", f"WITH {_cleaned()} SELECT * FROM cleaned"),
        "C6_clean_readings_clip_always": using(
            "dup", f"WITH {_cleaned('clip_always')} SELECT * FROM cleaned"
        ),
        "C6_clean_report": using(
            "dup",
            f"""WITH {_cleaned()}, n AS (SELECT (SELECT COUNT(*) FROM dup) AS i, (SELECT COUNT(*) FROM cleaned) AS f,
            (SELECT COUNT(*) FROM first_rows) AS u, (SELECT {ANOM} FROM cleaned) AS a)
            SELECT i AS initial_rows, f AS final_rows, i - f AS rows_removed, i - u AS duplicate_rows_removed,
            a AS anomaly_flags_count, {PCT('a', 'f', 6)} AS anomaly_flags_percentage FROM n""",
        ),
        "C7_simple_clean": using("dup", f"WITH {_simple()} SELECT * FROM simple"),
        "C7_simple_clean_report": using(
            "dup",
            f"""WITH {_simple()}, n AS (SELECT (SELECT COUNT(*) FROM dup) AS o, (SELECT COUNT(*) FROM simple) AS c,
            (SELECT {_nulls(DATA)} FROM dup) AS x, (SELECT {_nulls(DATA)} FROM simple) AS y,
            (SELECT {COUNT_IF('is_outlier = 1')} FROM simple) AS f)
            SELECT o AS original_records, c AS cleaned_records, o - c AS records_removed,
            {PCT('(o - c)', 'o')} AS removal_percentage, x AS original_nulls, y AS final_nulls,
            o - c AS duplicates_removed, f AS outliers_flagged, {PCT('c', 'o')} AS data_quality_score FROM n""",
        ),
        "C7_loose_range_report": using("readings", " UNION ALL ".join(loose)),
        "C8_zscore_flags": using(
            "readings",
            f"""SELECT _seq, coalesce(abs({P} - m) / NULLIF(s, 0) > 3, false) AS is_zscore_outlier
            FROM readings, (SELECT AVG({P}) AS m, STDDEV_SAMP({P}) AS s FROM readings)""",
        ),
        "C8_zscore_outliers": using(
            "readings",
            f"""SELECT Zone_ID, {COUNT_IF(f'abs({P} - m) / NULLIF(s, 0) > 3')} AS outliers, COUNT(*) AS readings
            FROM readings, (SELECT AVG({P}) AS m, STDDEV_SAMP({P}) AS s FROM readings) GROUP BY 1""",
        ),
    }


# --- features ---------------------------------------------------------------------

PF = "power_factor"


def _cyc(fn: str, x: str, period: int) -> str:
    return R(f"{fn}(2 * pi() * {x} / {period})", 9)


def _buckets(v: str, edges: str, labels) -> str:
    return (
        f"CASE WHEN {v} >= {edges}0 AND {v} <= {edges}1 THEN '{labels[0]}' "
        f"WHEN {v} > {edges}1 AND {v} <= {edges}2 THEN '{labels[1]}' "
        f"WHEN {v} > {edges}2 AND {v} <= {edges}3 THEN '{labels[2]}' WHEN {v} > {edges}3 THEN '{labels[3]}' END"
    )


def _edges(source: str) -> str:
    return f"(SELECT MIN({P}) AS e0, {Q(P, 0.25)} AS e1, {Q(P, 0.5)} AS e2, {Q(P, 0.75)} AS e3 FROM {source})"


def _group_totals(source: str) -> str:
    """Left joins that add the four group features to ``r``."""
    return f"""LEFT JOIN (SELECT Meter_ID AS m1, CAST({TS} AS DATE) AS d1, COALESCE({S(P)}, 0) AS md FROM {source}
        GROUP BY 1, 2) ON m1 = r.Meter_ID AND d1 = CAST(r.{TS} AS DATE)
        LEFT JOIN (SELECT Zone_ID AS z2, date_trunc('hour', {TS}) AS h2, COALESCE({S(P)}, 0) AS zh FROM {source}
        GROUP BY 1, 2) ON z2 = r.Zone_ID AND h2 = date_trunc('hour', r.{TS})
        LEFT JOIN (SELECT Meter_ID AS m3, {A(P)} AS ma FROM {source} GROUP BY 1) ON m3 = r.Meter_ID
        LEFT JOIN (SELECT Zone_ID AS z4, {A(P)} AS za FROM {source} GROUP BY 1) ON z4 = r.Zone_ID"""


CHANGE = f"""filled AS (SELECT *, LAST_VALUE({P} IGNORE NULLS) OVER (PARTITION BY Meter_ID ORDER BY {TS}, _seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p FROM readings),
    moved AS (SELECT *, LAG({P}) OVER w AS pv, LAG(p) OVER w AS pp FROM filled
        WINDOW w AS (PARTITION BY Meter_ID ORDER BY {TS}, _seq))"""
CHANGE_COLS = f"""{R(f'({P} - pv)', 9)} AS consumption_change,
    {R('((p / NULLIF(pp, 0) - 1) * 100)', 6)} AS consumption_change_pct"""


def _features() -> dict[str, str]:
    t = TS
    parts = f"""{I(f'hour({t})')} AS hour, {I(monday0(t))} AS day_of_week, {I(f'day({t})')} AS day_of_month,
        {I(f'month({t})')} AS month, {I(f'quarter({t})')} AS quarter, {I(f'year({t})')} AS year,
        {I(f'weekofyear({t})')} AS week_of_year, dayname({t}) AS day_name"""
    waves = ", ".join(
        f"{_cyc(fn, x, n)} AS {p}_{fn}"
        for p, x, n in (("hour", f"hour({t})", 24), ("month", f"month({t})", 12), ("dow", monday0(t), 7))
        for fn in ("sin", "cos")
    )

    def frame(n):
        return f"(PARTITION BY Meter_ID ORDER BY {t}, _seq ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"

    rolls = ", ".join(
        f"""{R(f'AVG({c}) OVER {frame(23)}', 9)} AS {c}_rolling_mean_24h,
        {R(f'STDDEV_SAMP({c}) OVER {frame(23)}', 6)} AS {c}_rolling_std_24h,
        {R(f'({c} - AVG({c}) OVER {frame(23)})', 9)} AS {c}_delta_from_mean_24h"""
        for c in ("Active_Power_kW", "Current_A", "Reactive_Power_kW")
    )
    span = f"(PARTITION BY Meter_ID ORDER BY {t} RANGE BETWEEN INTERVAL 23 HOURS PRECEDING AND CURRENT ROW)"
    raw_pf = f"CASE WHEN Apparent_Power_kVA = 0 THEN 0.0 ELSE {P} / NULLIF(Apparent_Power_kVA, 0) END"
    clip_pf = f"CASE WHEN ({raw_pf}) < 0 THEN 0.0 WHEN ({raw_pf}) > 1 THEN 1.0 ELSE ({raw_pf}) END"
    load = (
        f"CASE WHEN {P} > 0 AND {P} <= e1 THEN 'Low' WHEN {P} > e1 AND {P} <= e2 THEN 'Medium' "
        f"WHEN {P} > e2 AND {P} <= e3 THEN 'High' WHEN {P} > e3 THEN 'Critical' END"
    )
    return {
        "F1_temporal_and_season": using(
            "readings", f"SELECT _seq, {parts}, {waves}, {seasons(f'month({t})')} AS season FROM readings"
        ),
        "F1_temporal_all_months": using(
            "star_readings",
            f"""SELECT _seq, {I(f'weekofyear({t})')} AS week_of_year, dayname({t}) AS day_name,
            {I(f'quarter({t})')} AS quarter, {seasons(f'month({t})', 'temperate')} AS season FROM star_readings""",
        ),
        "F3_peak_power_factor_load": using(
            "light",
            f"""SELECT _seq, CASE WHEN {peak(f'hour({t})')} THEN 1 ELSE 0 END AS peak_hour_flag, power_factor,
            {bands(P)} AS load_category FROM light""",
        ),
        "F6_rolling_rows": using("readings", f"SELECT _seq, {rolls} FROM readings"),
        "F6_rolling_hours": using(
            "readings",
            f"SELECT _seq, {R(f'AVG({P}) OVER {span}', 9)} AS {P}_rolling_mean_24h FROM readings",
        ),
        "F7_consumption_bucket": using(
            "readings",
            f"""SELECT _seq, {_buckets(P, 'e', config.QUARTILE_BUCKETS)} AS consumption_bucket
            FROM readings, {_edges('readings')}""",
        ),
        "F8_group_features": using(
            "readings",
            f"""SELECT r._seq, md AS meter_daily_consumption_kWh, zh AS zone_hourly_consumption_kWh,
            ma AS meter_avg_power_kW, za AS zone_avg_power_kW FROM readings r {_group_totals('readings')}""",
        ),
        "F9_feature_table": using(
            "dup",
            f"""WITH {_cleaned()}, wide AS (SELECT *, AVG({P}) OVER {frame(23)} AS rm FROM cleaned)
            SELECT r._seq, {I(f'hour(r.{t})')} AS hour, {seasons(f'month(r.{t})')} AS season,
            CASE WHEN {peak(f'hour(r.{t})')} THEN 1 ELSE 0 END AS peak_hour_flag, {clip_pf} AS power_factor,
            {bands(P)} AS load_category, {R('rm', 9)} AS {P}_rolling_mean_24h,
            {_buckets(P, 'e', config.QUARTILE_BUCKETS)} AS consumption_bucket, md AS meter_daily_consumption_kWh,
            za AS zone_avg_power_kW, is_anomaly FROM wide r {_group_totals('cleaned')}, {_edges('cleaned')}""",
        ),
        "F10_exploratory_features": using(
            "readings",
            f"""WITH {CHANGE}, rolled AS (SELECT *, AVG({P}) OVER {frame(23)} AS a, AVG({P}) OVER {frame(167)} AS b
            FROM moved)
            SELECT _seq, {I(f'day({t})')} AS day, {I(f'dayofyear({t})')} AS day_of_year,
            CASE WHEN {monday0(t)} >= 5 THEN 1 ELSE 0 END AS is_weekend,
            {seasons(f'month({t})', 'temperate')} AS season,
            CASE WHEN {peak(f'hour({t})', 'morning_evening')} THEN 1 ELSE 0 END AS peak_hour_flag,
            {rating(f'({raw_pf})', config.READING_PF_RATING)} AS power_factor_category, {load} AS load_category,
            {_flag([P])} AS is_anomaly, {R('a', 9)} AS power_rolling_24h, {R('b', 11)} AS power_rolling_7d,
            {CHANGE_COLS} FROM rolled, {_edges('readings')}, {_fences([P], 'readings')}""",
        ),
        "W17_consumption_change": using("readings", f"WITH {CHANGE} SELECT _seq, {CHANGE_COLS} FROM moved"),
        "W1_row_number": using(
            "readings",
            f"SELECT _seq, ROW_NUMBER() OVER (PARTITION BY Meter_ID ORDER BY {t}, _seq) AS row_number FROM readings",
        ),
    }


# --- validation -----------------------------------------------------------------


def _validation() -> dict[str, str]:
    null_rows = " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, {COUNT_IF(f'"{c}" IS NULL')} AS null_count, COUNT(*) AS total_count,
        {PCT(COUNT_IF(f'"{c}" IS NULL'), 'COUNT(*)', 6)} AS null_percentage FROM dup"""
        for c in DATA
    )
    ranges = " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, {COUNT_IF(f'{c} < {lo} OR {c} > {hi}')} AS out_of_range_count,
        CAST({lo} AS DOUBLE) AS valid_min, CAST({hi} AS DOUBLE) AS valid_max FROM {{src}}"""
        for c, (lo, hi) in config.VALID_RANGES.items()
    )
    dups = f"u AS (SELECT COUNT(*) AS d FROM (SELECT DISTINCT {DATA_SQL} FROM dup)), n AS (SELECT COUNT(*) AS t FROM dup)"
    full = f"t AS total_rows, t - d AS duplicate_rows, {PCT('(t - d)', 't', 6)} AS duplicate_percentage"
    keys = f"(SELECT COUNT(*) FROM (SELECT 1 FROM dup GROUP BY Meter_ID, {TS} HAVING COUNT(*) > 1))"
    surplus = f"(SELECT t - COUNT(*) FROM (SELECT 1 FROM dup GROUP BY Meter_ID, {TS}))"
    late = f"(SELECT {COUNT_IF(TS + ' > TIMESTAMP ' + chr(39) + '2024-01-15' + chr(39))} FROM dup)"
    issues = f"""i AS (SELECT 'missing_columns' AS issue, {N('0')} AS issue_count UNION ALL
        SELECT 'duplicate_keys', {keys} UNION ALL SELECT 'future_readings', {late})"""
    cells = _nulls(DATA)
    score = f"(100.0 - CAST((SELECT {cells} FROM dup) AS DOUBLE) * 100.0 / (t * {len(DATA)}))"
    span = "epoch_us(b) - epoch_us(a)"
    rng = f"r AS (SELECT MIN({TS}) AS a, MAX({TS}) AS b FROM dup)"
    days = f"CAST(floor((({span}) // 1000000) / 86400) AS BIGINT)"
    report = f"""t AS total_rows, {N(len(DATA))} AS total_columns, (SELECT {cells} FROM dup) AS null_cells,
        t - d AS duplicate_rows, {PCT('(t - d)', 't', 6)} AS duplicate_percentage, {R(score, 6)} AS data_quality_score"""
    describe = " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT({c}) AS count, {R(f'AVG({c})', 6)} AS mean,
        {R(f'STDDEV_SAMP({c})', 6)} AS std, MIN({c}) AS min, MAX({c}) AS max, {Q(c, 0.25)} AS q25, {Q(c, 0.5)} AS q50,
        {Q(c, 0.75)} AS q75 FROM readings"""
        for c in MEASURES
    )
    texts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, COUNT(*) AS row_count FROM dup WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in TEXTS
    )
    any_flag = _flag(MEASURES)
    checks = f"""c AS (SELECT 'completeness' AS check_name, COUNT(*) FILTER (WHERE null_percentage > 5) AS failures
          FROM ({null_rows})
        UNION ALL SELECT 'uniqueness', CASE WHEN 100.0 * (t - d) / t > 1 THEN 1 ELSE 0 END FROM u, n
        UNION ALL SELECT 'validity', COUNT(*) FILTER (WHERE out_of_range_count > 0) FROM ({ranges.format(src='dup')})
        UNION ALL SELECT 'consistency', COUNT(*) FILTER (WHERE issue_count > 0) FROM i
        UNION ALL SELECT 'anomalies', 0)"""
    return {
        "V1_completeness": using("dup", f"SELECT *, null_percentage <= 5 AS passed FROM ({null_rows})"),
        "V2_uniqueness": using(
            "dup", f"WITH {dups} SELECT {full}, {PCT('(t - d)', 't', 6)} <= 1 AS passed FROM u, n"
        ),
        "V3_validity": using(
            "dup", f"SELECT *, out_of_range_count = 0 AS passed FROM ({ranges.format(src='dup')})"
        ),
        "V4_consistency": using("dup", f"WITH {issues} SELECT *, issue_count = 0 AS passed FROM i"),
        "V4_modal_gap": using(
            "dup",
            f"""WITH g AS (SELECT epoch_us({TS}) - LAG(epoch_us({TS})) OVER (ORDER BY {TS}) AS gap FROM dup)
            SELECT CAST(gap AS DOUBLE) / 1000000 AS modal_gap_seconds, COUNT(*) AS occurrences FROM g
            WHERE gap IS NOT NULL GROUP BY gap ORDER BY COUNT(*) DESC, gap LIMIT 1""",
        ),
        "V5_anomaly_share": using(
            "readings",
            f"""WITH f AS (SELECT {any_flag} AS is_anomaly FROM readings, {_fences(MEASURES, 'readings')})
            SELECT COUNT(*) AS total_rows, {ANOM} AS anomaly_count, {PCT(ANOM, 'COUNT(*)', 6)} AS anomaly_percentage,
            {PCT(ANOM, 'COUNT(*)', 6)} <= 10 AS passed FROM f""",
        ),
        "V6_lineage": using(
            "dup",
            f"""SELECT COUNT(*) AS total_rows, {N(len(DATA))} AS total_columns, MIN({TS}) AS start, MAX({TS}) AS "end",
            COUNT(DISTINCT Meter_ID) AS meter_ids, COUNT(DISTINCT Zone_ID) AS zone_ids FROM dup""",
        ),
        "V7_validate": using(
            "dup",
            f"""WITH {dups}, {issues}, {checks}
            SELECT check_name, failures = 0 AS passed, {N('failures')} AS failures FROM c
            UNION ALL SELECT 'overall', bool_and(failures = 0), {N('SUM(failures)')} FROM c""",
        ),
        "V8_quality_report": using("dup", f"WITH {dups} SELECT {report} FROM u, n"),
        "V8_describe": using("readings", describe),
        "V9_ingestion_report": using(
            "dup",
            f"""WITH {dups}, {rng} SELECT {report}, {keys} AS duplicate_keys, {surplus} AS surplus_rows,
            a AS first_reading, b AS last_reading, {days} AS duration_days,
            {R(f'(CAST(t AS DOUBLE) / CASE WHEN {days} = 0 THEN 1 ELSE {days} END)', 6)} AS rows_per_day,
            (SELECT COUNT(DISTINCT Meter_ID) FROM dup) AS meter_ids, (SELECT COUNT(DISTINCT Zone_ID) FROM dup) AS zone_ids
            FROM u, n, r""",
        ),
        "V9_categorical_summary": using(
            "dup",
            f"""WITH c AS ({texts}), k AS (SELECT column_name, COUNT(*) AS unique_values FROM c GROUP BY 1)
            SELECT column_name, unique_values, value, row_count FROM c JOIN k USING (column_name)
            WHERE unique_values <= 10 UNION ALL
            SELECT column_name, unique_values, NULL, NULL FROM k WHERE unique_values > 10""",
        ),
        "V9_value_counts": using("dup", "SELECT Meter_ID, COUNT(*) AS row_count FROM dup GROUP BY 1"),
        "V10_completeness_score": using(
            "dup",
            f"""WITH n AS (SELECT COUNT(*) AS t FROM dup) SELECT t AS total_rows, (SELECT {cells} FROM dup) AS null_cells,
            {R(score, 6)} AS data_quality_score FROM n""",
        ),
    }


# --- materialised aggregates ---------------------------------------------------------


def _aggregates() -> dict[str, str]:
    t = TS
    z = "CAST(0 AS DOUBLE)"
    daily = f"""SELECT CAST({t} AS DATE) AS "Date", Meter_ID, COALESCE({S(P)}, {z}) AS Total_kWh, {A(P)} AS Avg_kW,
        MIN({P}) AS Min_kW, MAX({P}) AS Max_kW, COUNT({P}) AS "Count" FROM {{src}} GROUP BY 1, 2"""
    fact_daily = f"""SELECT CAST(ts AS DATE) AS reading_date, meter_id, zone_id, {S(V)} AS total_consumption_kwh,
        {A(V)} AS avg_power_kw, MAX({V}) AS max_power_kw, MIN({V}) AS min_power_kw,
        COALESCE({S(f'CASE WHEN peak_hour_flag = 1 THEN {V} END')}, {z}) AS peak_consumption_kwh,
        COALESCE({S(f'CASE WHEN peak_hour_flag <> 1 THEN {V} END')}, {z}) AS off_peak_consumption_kwh,
        {R(A('power_factor'), 6)} AS avg_power_factor, {A('frequency_hz')} AS avg_frequency_hz,
        {ANOM} AS anomaly_count, COUNT(*) AS reading_count FROM flagged_fact GROUP BY 1, 2, 3"""
    dim_t = 'ts'
    pieces = ("Active_Power_kW", "Current_A", "Voltage_V")
    records = " UNION ALL ".join(
        f"""SELECT _seq AS reading_id, {t} AS timestamp, Meter_ID AS meter_id, Zone_ID AS zone_id,
        'outlier' AS anomaly_type, '{c}' AS anomaly_column,
        CASE WHEN {c} < lo_{c} THEN lo_{c} ELSE hi_{c} END AS expected_value, {c} AS actual_value
        FROM readings, f WHERE {_outside(c)}"""
        for c in pieces
    )
    total_out = " + ".join(
        COUNT_IF(f"{c} < {lo} OR {c} > {hi}") for c, (lo, hi) in config.VALID_RANGES.items()
    )
    profile = f"CASE WHEN {{v}} >= 0 AND {{v}} < 1 THEN 1 WHEN {{v}} >= 1 AND {{v}} < 3 THEN 2 WHEN {{v}} >= 3 AND {{v}} < 10 THEN 3 WHEN {{v}} >= 10 AND {{v}} < 25 THEN 4 END"
    log_cols = DATA + ["is_anomaly"]
    return {
        "M1_daily_by_meter": using("readings", daily.format(src="readings")),
        "M1_daily_by_meter_bulk": using("bulk", daily.format(src="bulk")),
        "M2_hourly_by_zone": using(
            "readings",
            f"""SELECT date_trunc('hour', {t}) AS "Hour", Zone_ID, COALESCE({S(P)}, {z}) AS Total_kWh, {A(P)} AS Avg_kW,
            COUNT({P}) AS "Count" FROM readings GROUP BY 1, 2""",
        ),
        "M3_by_peak_flag": using(
            "readings",
            f"""SELECT CASE WHEN {peak(f'hour({t})')} THEN 1 ELSE 0 END AS Is_Peak_Hour, COALESCE({S(P)}, {z}) AS Total_kWh,
            {A(P)} AS Avg_kW, {R(f'STDDEV_SAMP({P})', 6)} AS Std_kW, COUNT({P}) AS "Count" FROM readings GROUP BY 1""",
        ),
        "M4_load_category_counts": using(
            "readings", f'SELECT {bands(P)} AS load_category, COUNT(*) AS "Count" FROM readings GROUP BY 1'
        ),
        "M5_agg_daily": using("flagged_fact", fact_daily),
        "M6_agg_hourly_zone": using(
            "fact",
            f"""SELECT date_trunc('hour', ts) AS reading_hour, zone_id, {S(V)} AS total_consumption_kwh,
            {A(V)} AS avg_power_kw, MAX({V}) AS max_power_kw, MIN({V}) AS min_power_kw,
            COUNT(DISTINCT meter_id) AS meter_count FROM fact GROUP BY 1, 2""",
        ),
        "M7_agg_monthly": using(
            "star_fact",
            f"""WITH d AS (SELECT year, month, CAST(ts AS DATE) AS d, meter_id, zone_id, {S(V)} AS s, {ANOM} AS a,
            COUNT(*) AS n FROM star_fact GROUP BY 1, 2, 3, 4, 5)
            SELECT {I('year')} AS year, {I('month')} AS month, meter_id, zone_id, {S('s')} AS total_consumption_kwh,
            {A('s')} AS avg_daily_consumption_kwh, MAX(s) AS max_daily_consumption_kwh,
            MIN(s) AS min_daily_consumption_kwh, {N('SUM(a)')} AS total_anomalies, {N('SUM(n)')} AS reading_count
            FROM d GROUP BY year, month, meter_id, zone_id""",
        ),
        "M8_dim_time": using(
            "star",
            f"""WITH d AS (SELECT DISTINCT ts FROM star WHERE ts IS NOT NULL)
            SELECT epoch_us({dim_t}) AS time_id, ts AS timestamp, {I('hour(ts)')} AS hour,
            {I(monday0('ts'))} AS day_of_week, {I('day(ts)')} AS day_of_month, {I('month(ts)')} AS month,
            {I('quarter(ts)')} AS quarter, {I('year(ts)')} AS year, {I('weekofyear(ts)')} AS week_of_year,
            dayname(ts) AS day_name, CASE WHEN {peak('hour(ts)')} THEN 1 ELSE 0 END AS is_peak_hour,
            {seasons('month(ts)')} AS season FROM d""",
        ),
        "M8_dim_meter": using(
            "meters", "SELECT meter_id, meter_name, 'Smart Meter' AS meter_type, 'Active' AS status FROM meters"
        ),
        "M8_dim_zone": using("zones", "SELECT zone_id, zone_name, district FROM zones"),
        "M8_fact": using(
            "flagged_fact",
            f"""SELECT reading_id, ts AS timestamp, meter_id, zone_id, epoch_us(ts) AS time_id,
            {I(profile.format(v=V))} AS load_profile_id, power_factor, {I('hour_of_day')} AS hour_of_day, peak_hour_flag,
            load_category, {I('year')} AS year, {I('month')} AS month, {I('day_of_week')} AS day_of_week, season,
            is_anomaly FROM flagged_fact""",
        ),
        "M8_insert_absent": using(
            "star star_meters",
            """WITH old AS (SELECT meter_id, meter_name, 'Active' AS status FROM star_meters
            WHERE CAST(meter_id AS BIGINT) % 3 = 0), fresh AS (SELECT DISTINCT meter_id FROM star)
            SELECT * FROM old UNION ALL SELECT meter_id, 'Meter ' || meter_id, 'Active' FROM fresh
            WHERE meter_id NOT IN (SELECT meter_id FROM old)""",
        ),
        "J10_band_lookup": using(
            "fact", f"SELECT reading_id, {I(profile.format(v=V))} AS load_profile_id FROM fact"
        ),
        "J10_many_bands": using(
            "readings",
            f"""WITH b AS (SELECT p_partkey AS band, (p_retailprice - 900) / 50 AS x FROM part), c AS (
            SELECT band, CASE WHEN band % 400 <> 0 THEN x END AS lo, CASE WHEN band % 400 <> 1 THEN x + (band % 9) / 40.0::DOUBLE END AS hi FROM b)
            SELECT _seq AS reading_id, COUNT(band) AS bands, MIN(band) AS first_band FROM readings LEFT JOIN c
            ON {P} IS NOT NULL AND (lo IS NULL OR {P} >= lo) AND (hi IS NULL OR {P} < hi) GROUP BY 1""",
        ),
        "J11_second_delivery": using(
            "readings",
            f"""SELECT CAST({TS} AS DATE) AS reading_date, Meter_ID AS meter_id, Zone_ID AS zone_id, {R(S(P), 6)} AS total_kwh,
            COUNT(*) AS reading_count FROM readings GROUP BY 1, 2, 3""",
        ),
        "M9_quality_log": using(
            "readings",
            f"""WITH f AS (SELECT {DATA_SQL}, {_flag([P])} AS is_anomaly FROM readings, {_fences([P], 'readings')}),
            n AS (SELECT COUNT(*) AS t, {_nulls(log_cols)} AS x, {ANOM} AS a, {total_out} AS o,
            (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM f)) AS d FROM f),
            s AS (SELECT *, {R(f'(100.0 - CAST(x AS DOUBLE) * 100.0 / (t * {len(log_cols)}))', 6)} AS q FROM n)
            SELECT t AS total_rows, x AS null_count, t - d AS duplicate_count, a AS anomaly_count,
            {N('o')} AS out_of_range_count, {R('(100.0 - q)', 6)} AS null_percentage,
            {PCT('(t - d)', 't', 6)} AS duplicate_percentage, {PCT('a', 't', 6)} AS anomaly_percentage,
            {PCT('o', 't', 6)} AS out_of_range_percentage, q AS quality_score,
            CASE WHEN 100.0 - q <= 5 AND 100.0 * (t - d) / t <= 1 AND 100.0 * a / t <= 10 THEN 'PASSED' ELSE 'FAILED' END
            AS status FROM s""",
        ),
        "M9_anomaly_records": using(
            "readings",
            f"""WITH f AS (SELECT * FROM {_fences(pieces, 'readings')}), r AS ({records})
            SELECT *, {R('((actual_value - expected_value) * 100.0 / NULLIF(abs(expected_value), 0))', 6)}
            AS deviation_percentage FROM r""",
        ),
        "M10_current_meter_status": using(
            "star_fact star_meters star_zones",
            f"""WITH g AS (SELECT meter_id, zone_id, MAX(ts) AS last_reading_timestamp, COUNT(reading_id) AS n, {ANOM} AS a
            FROM star_fact GROUP BY 1, 2)
            SELECT m.meter_id, meter_name, g.zone_id, zone_name, 'Active' AS status, last_reading_timestamp,
            COALESCE(n, 0) AS total_readings, COALESCE(a, 0) AS anomaly_count
            FROM star_meters m LEFT JOIN g ON m.meter_id = g.meter_id LEFT JOIN star_zones z ON z.zone_id = g.zone_id""",
        ),
        "M11_daily_comparison": using(
            "star_fact star_zones",
            f"""WITH d AS (SELECT CAST(ts AS DATE) AS reading_date, meter_id, zone_id, {S(V)} AS s, {A(V)} AS a
            FROM star_fact GROUP BY 1, 2, 3), g AS (SELECT reading_date, zone_id, {S('s')} AS zone_total_kwh,
            {R('AVG(a)', 9)} AS zone_avg_power_kw, COUNT(DISTINCT meter_id) AS meter_count FROM d GROUP BY 1, 2)
            SELECT reading_date, zone_id, zone_name, zone_total_kwh, zone_avg_power_kw, meter_count
            FROM g LEFT JOIN star_zones USING (zone_id)""",
        ),
        "M12_peak_hour_performance": using(
            "flagged_fact",
            f"""SELECT {I('hour_of_day')} AS hour_of_day, zone_id, COUNT(*) AS reading_count, {A(V)} AS avg_load_kw,
            MAX({V}) AS peak_load_kw, MIN({V}) AS min_load_kw, {R(A('power_factor'), 6)} AS avg_power_factor,
            {ANOM} AS anomaly_count FROM flagged_fact WHERE peak_hour_flag = 1 GROUP BY hour_of_day, zone_id""",
        ),
        "M13_meter_summary": using(
            "readings",
            f"""SELECT Meter_ID, COUNT(*) AS record_count, {R(A(P), 3)} AS avg_power_kW, MAX({P}) AS max_power_kW,
            MIN({P}) AS min_power_kW FROM readings GROUP BY 1""",
        ),
        "M13_zone_summary": using(
            "readings",
            f"""SELECT Zone_ID, COUNT(*) AS record_count, {R(A(P), 3)} AS avg_power_kW, MAX(Voltage_V) AS max_voltage_V
            FROM readings GROUP BY 1""",
        ),
    }


# --- analyses and chart data -----------------------------------------------------------


def _analyses() -> dict[str, str]:
    t, std = TS, R(f"STDDEV_SAMP({P})", 6)
    hourly = f"SELECT {I(f'hour({t})')} AS hour, {A(P)} AS mean, {{more}} FROM readings GROUP BY hour({t})"
    stats = f"{std} AS std, MIN({P}) AS min, MAX({P}) AS max, COUNT({P}) AS count"

    def ends(label, source, top, bottom, show="{x}"):
        return f"""SELECT * FROM (SELECT {show.format(x=label)} AS {top}, mean AS {top}_avg FROM {source}
            ORDER BY mean DESC, {label} LIMIT 1), (SELECT {show.format(x=label)} AS {bottom}, mean AS {bottom}_avg
            FROM {source} ORDER BY mean, {label} LIMIT 1)"""

    month = "strftime(make_date(2000, CAST({x} AS BIGINT), 1), '%b')"
    monthly = f"SELECT {I(f'month({t})')} AS month, {A(P)} AS mean, {std} AS std FROM star_readings GROUP BY month({t})"
    hist = """WITH e AS (SELECT MIN({c}) AS lo, MAX({c}) AS hi, (MAX({c}) - MIN({c})) / 50 AS w FROM readings),
        b AS (SELECT CAST(LEAST(CASE WHEN w > 0 THEN floor(({c} - lo) / w) ELSE 0 END, 49) AS INTEGER) AS bin,
        COUNT(*) AS n FROM readings, e WHERE {c} IS NOT NULL GROUP BY 1),
        g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(50))
        SELECT bin, {lo} AS bin_low, {hi} AS bin_high, COALESCE(n, 0) AS count FROM g CROSS JOIN e LEFT JOIN b USING (bin)"""
    lo, hi = R("(lo + w * bin)", 9), R("(lo + w * (bin + 1))", 9)
    top = "SELECT Meter_ID, {a} AS mean FROM {src} WHERE Meter_ID IS NOT NULL GROUP BY 1 ORDER BY mean DESC NULLS LAST, Meter_ID LIMIT 10"
    f1 = _fences([P], "readings")
    out_cond = _outside(P)
    q = {p: Q(P, p) for p in (0.05, 0.25, 0.5, 0.75, 0.95)}
    flat = {
        "A1_hourly_stats": hourly.format(more=stats),
        "A1_peak_hours": f"WITH h AS ({hourly.format(more='1 AS x')}) " + ends("hour", "h", "peak_hour", "off_peak_hour"),
        "A1_top_hours": f"SELECT hour, mean FROM ({hourly.format(more='1 AS x')}) ORDER BY mean DESC, hour LIMIT 5",
        "A2_zone_stats": f"""SELECT Zone_ID, COUNT({P}) AS count, {A(P)} AS mean, {std} AS std, MIN({P}) AS min,
            MAX({P}) AS max, COALESCE({S(P)}, 0) AS total, {q[0.25]} AS q25, {q[0.75]} AS q75 FROM readings
            WHERE Zone_ID IS NOT NULL GROUP BY 1""",
        "A2_zone_ends": f"WITH z AS (SELECT Zone_ID, {A(P)} AS mean FROM readings GROUP BY 1) "
        + ends("Zone_ID", "z", "highest_zone", "lowest_zone"),
        "A3_top_consumers": f"""WITH m AS (SELECT Meter_ID, COUNT({P}) AS records, {A(P)} AS mean, {std} AS std,
            MIN({P}) AS min, MAX({P}) AS max, arg_min(Zone_ID, ({t}, _seq)) FILTER (WHERE Zone_ID IS NOT NULL) AS Zone_ID
            FROM readings WHERE Meter_ID IS NOT NULL GROUP BY 1 ORDER BY mean DESC NULLS LAST, Meter_ID LIMIT 20)
            SELECT *, (SELECT {S('mean')} FROM m) AS total_top_consumption FROM m""",
        "A4_anomaly_summary": f"""WITH r AS (SELECT *, CASE WHEN {out_cond} THEN {P} END AS x FROM readings, {f1})
            SELECT COUNT(x) AS total_anomalies, {PCT('COUNT(x)', 'COUNT(*)', 6)} AS anomaly_rate,
            MAX(lo_{P}) AS lower_bound, MAX(hi_{P}) AS upper_bound, MAX(a_{P}) AS q1, MAX(b_{P}) AS q3,
            MAX(b_{P}) - MAX(a_{P}) AS iqr, COALESCE({A('x')}, 0) AS anomaly_mean, COALESCE(MIN(x), 0) AS anomaly_min,
            COALESCE(MAX(x), 0) AS anomaly_max FROM r""",
        "A4_anomalies_by_zone": f"""SELECT Zone_ID, COUNT(*) AS count FROM readings, {f1}
            WHERE {out_cond} AND Zone_ID IS NOT NULL GROUP BY 1""",
        "A7_load_profile": f"""SELECT {I(monday0(t))} AS day_of_week, {I(f'hour({t})')} AS hour,
            dayname({t}) AS day_name, {A(P)} AS mean FROM readings GROUP BY {monday0(t)}, hour({t}), dayname({t})""",
        "A7_weekday_weekend": f"""SELECT {A(f'CASE WHEN {monday0(t)} < 5 THEN {P} END')} AS weekday_avg,
            {A(f'CASE WHEN {monday0(t)} >= 5 THEN {P} END')} AS weekend_avg FROM readings""",
        "E1_hourly_band": f"""WITH h AS ({hourly.format(more=std + ' AS std')})
            SELECT hour, mean, std, {R('(mean - std)', 6)} AS band_low, {R('(mean + std)', 6)} AS band_high FROM h""",
        "E2_by_day_of_month": f"""WITH d AS (SELECT {I(f'day({t})')} AS day_of_month, {A(P)} AS mean, COUNT({P}) AS count
            FROM readings GROUP BY day({t})) SELECT *, CASE WHEN ROW_NUMBER() OVER
            (ORDER BY mean DESC NULLS LAST, day_of_month) = 1 THEN 1 ELSE 0 END AS is_top_day FROM d""",
        "E2_by_date": f"""SELECT CAST({t} AS DATE) AS date, {A(P)} AS mean FROM readings GROUP BY 1
            ORDER BY date DESC LIMIT 30""",
        "E4_zone_mean_std": f"SELECT Zone_ID, {A(P)} AS mean, {std} AS std FROM readings GROUP BY 1",
        "E5_peak_comparison": f"""WITH r AS (SELECT *, CASE WHEN {peak(f'hour({t})', 'extended')} THEN 'Peak'
            ELSE 'Off-Peak' END AS period FROM readings), s AS (SELECT period, {A(P)} AS mean, {std} AS std,
            COUNT({P}) AS count, {q[0.25]} AS q25, {q[0.5]} AS q50, {q[0.75]} AS q75 FROM r GROUP BY 1),
            w AS (SELECT period, MIN({P}) AS whisker_low, MAX({P}) AS whisker_high FROM r JOIN s USING (period)
            WHERE {P} >= q25 - 1.5 * (q75 - q25) AND {P} <= q75 + 1.5 * (q75 - q25) GROUP BY 1)
            SELECT * FROM s LEFT JOIN w USING (period)""",
        "E6_power_histogram": hist.format(c=P, lo=lo, hi=hi),
        "E7_anomaly_overview": f"""WITH z AS (SELECT Zone_ID, COUNT(*) AS anomaly_count FROM readings, {f1}
            WHERE {out_cond} GROUP BY 1)
            SELECT *, {PCT('anomaly_count', '(SELECT SUM(anomaly_count) FROM z)', 6)} AS share_percentage FROM z""",
        "E8_top_meters": top.format(a=A(P), src="readings"),
        "E9_hourly_reactive": f"""SELECT {I(f'hour({t})')} AS hour, {A('Reactive_Power_kW')} AS mean FROM readings
            GROUP BY hour({t})""",
        "E9_reactive_pairs": f"""SELECT {P}, Reactive_Power_kW FROM readings
            WHERE {P} IS NOT NULL AND Reactive_Power_kW IS NOT NULL""",
        "E10_voltage_statistics": f"""SELECT {A('Voltage_V')} AS mean, {R('STDDEV_SAMP(Voltage_V)', 6)} AS std,
            MIN(Voltage_V) AS min, MAX(Voltage_V) AS max, {Q('Voltage_V', 0.5)} AS median FROM readings""",
        "E10_voltage_histogram": hist.format(c="Voltage_V", lo=lo, hi=hi),
        "E11_hourly_max": f"SELECT {I(f'hour({t})')} AS hour, MAX({P}) AS peak FROM readings GROUP BY hour({t})",
        "E11_daily_mean": f"SELECT CAST({t} AS DATE) AS date, {A(P)} AS mean FROM readings GROUP BY 1",
        "E12_overview": "SELECT COUNT(*) AS total_records, COUNT(DISTINCT Zone_ID) AS zones FROM readings",
    }
    out = {k: using("readings", v) for k, v in flat.items()}
    out["A5_monthly_stats"] = using("star_readings", f"SELECT *, {month.format(x='month')} AS month_name FROM ({monthly})")
    out["E3_monthly_mean"] = using(
        "star_readings", f"SELECT month, {month.format(x='month')} AS month_name, mean FROM ({monthly})"
    )
    out["A5_quarterly_stats"] = using(
        "star_readings",
        f"SELECT {I(f'quarter({t})')} AS quarter, {A(P)} AS mean, {std} AS std FROM star_readings GROUP BY quarter({t})",
    )
    out["A5_month_ends"] = using(
        "star_readings",
        f"WITH m AS ({monthly}) " + ends("month", "m", "highest_month", "lowest_month", month),
    )
    out["A6_power_factor_stats"] = using(
        "light",
        f"""SELECT {R(A(PF), 6)} AS mean_pf, {Q(PF, 0.5)} AS median_pf, {R(f'STDDEV_SAMP({PF})', 6)} AS std_pf,
        MIN({PF}) AS min_pf, MAX({PF}) AS max_pf, {COUNT_IF(f'{PF} < 0.85')} AS poor_pf_records,
        {PCT(COUNT_IF(f'{PF} < 0.85'), 'COUNT(*)', 6)} AS poor_pf_percentage FROM light""",
    )
    out["E8_top_meters_bulk"] = using("bulk", top.format(a=A(P), src="bulk"))
    out["AG5_zone_quantiles_bulk"] = using(
        "bulk",
        f"""SELECT Zone_ID, {q[0.05]} AS q05, {q[0.25]} AS q25, {q[0.5]} AS q50, {q[0.75]} AS q75, {q[0.95]} AS q95
        FROM bulk GROUP BY 1""",
    )
    out["AG5_bracketed_quantiles"] = out["AG5_zone_quantiles_bulk"]
    out["AG5_daily_sketches"] = using(
        "bulk",
        f"""SELECT Zone_ID, CAST(date_trunc('month', {t}) AS DATE) AS month, COUNT({P}) AS n, TRUE AS within
        FROM bulk WHERE Zone_ID IS NOT NULL AND {P} IS NOT NULL GROUP BY 1, 2""",
    )
    out["AG9_merged_distinct"] = using(
        "star_readings",
        f"""SELECT Zone_ID AS zone_id, {I(f'year({t})')} AS year, {I(f'month({t})')} AS month, COUNT(DISTINCT Meter_ID) AS meters,
        TRUE AS within FROM star_readings WHERE Zone_ID IS NOT NULL GROUP BY 1, 2, 3""",
    )
    out["W3_rank_counted"] = using(
        "bulk", f"SELECT *, RANK() OVER (PARTITION BY Zone_ID ORDER BY {P} DESC NULLS LAST) AS power_rank FROM bulk"
    )
    out["W10_running_without_time"] = using(
        "readings",
        f"""SELECT _seq, ROW_NUMBER() OVER w AS reading_number, COUNT({P}) OVER w AS with_power FROM readings
        WINDOW w AS (PARTITION BY Zone_ID ORDER BY CASE _seq % 3 WHEN 1 THEN TIMESTAMP '2024-01-01' WHEN 2 THEN {t} END
        NULLS FIRST, _seq ROWS UNBOUNDED PRECEDING)""",
    )
    out["AG10_distinct_bulk"] = using(
        "bulk",
        f"""SELECT Zone_ID, COUNT(*) AS readings, COUNT(DISTINCT Meter_ID) AS meters,
        COUNT(DISTINCT CAST({t} AS DATE)) AS days, COUNT(DISTINCT (Meter_ID, CAST({t} AS DATE))) AS meter_days
        FROM bulk GROUP BY 1""",
    )
    out["SF1_parse_timestamps"] = """SELECT event_id, CASE WHEN event_id % 7 IN (0, 1, 2, 3)
        THEN date_trunc('second', ts) WHEN event_id % 7 IN (4, 5) THEN CAST(date_trunc('day', ts) AS TIMESTAMP) END
        AS parsed FROM events"""
    out["SF18_json_round_trip"] = using("readings", f"SELECT {DATA_SQL} FROM readings")
    out["IO17_analytics_projection"] = using(
        "light",
        f"""SELECT _seq, {t}, Meter_ID, Zone_ID, {P}, Reactive_Power_kW, Apparent_Power_kVA, Voltage_V, Current_A,
        Frequency_Hz, Outdoor_Temp_C, {I(f'hour({t})')} AS hour, {I(monday0(t))} AS day_of_week,
        {I(f'month({t})')} AS month, {seasons(f'month({t})')} AS season,
        CASE WHEN {peak(f'hour({t})')} THEN 1 ELSE 0 END AS peak_hour_flag, power_factor, {bands(P)} AS load_category,
        {_buckets(P, 'e', config.QUARTILE_BUCKETS)} AS consumption_bucket, {_flag([P])} AS is_anomaly_raw
        FROM light, {_edges('light')}, {_fences([P], 'light')}""",
    )
    return out


# --- streams ---------------------------------------------------------------------


def _streams() -> dict[str, str]:
    batch = _aggregates()
    bad = " + ".join(
        f"CASE WHEN {c} < {lo} OR {c} > {hi} THEN 1 ELSE 0 END" for c, (lo, hi) in config.VALID_RANGES.items()
    )
    gone = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in config.VALID_RANGES)
    return {
        "ST3_decode": using("readings", f"SELECT {DATA_SQL} FROM readings WHERE _seq % 50 <> 0"),
        "ST3_dead_letters": using(
            "readings",
            "SELECT CASE WHEN _seq % 50 = 0 THEN 1 ELSE 0 END AS malformed, COUNT(*) AS messages FROM readings GROUP BY 1",
        ),
        "ST8_deduplicate": using("readings", f"SELECT {DATA_SQL} FROM readings"),
        "ST9_hourly_by_zone": batch["M2_hourly_by_zone"],
        "ST9_daily_by_meter": batch["M1_daily_by_meter"],
        "ST10_sliding_average": using(
            "readings",
            f"""WITH w AS (SELECT date_trunc('hour', {TS}) - to_hours(CAST(range AS BIGINT)) AS s, {P}
            FROM readings, range(24))
            SELECT s AS window_start, s + INTERVAL 24 HOURS AS window_end, {A(P)} AS avg_power_kw FROM w GROUP BY 1""",
        ),
        "ST11_range_flags": using(
            "readings", f"SELECT _seq, {I(bad)} AS out_of_range, {I(gone)} AS missing FROM readings"
        ),
        "IO18_sample": using(
            "readings", f"SELECT _seq FROM readings WHERE left(md5('{config.SAMPLE_SEED}:' || CAST(_seq AS VARCHAR)), 8) < '1999999a'"
        ),
        "AG1_extreme_values": using(
            "readings",
            f"""WITH x AS (SELECT Meter_ID, CASE WHEN _seq % 50 = 1 THEN 1e12 WHEN _seq % 50 = 2 THEN 4e-8
            WHEN _seq % 5000 = 3 THEN CAST('inf' AS DOUBLE) ELSE {P} END AS v FROM readings)
            SELECT Meter_ID, {R('SUM(v)', 0)} AS total, {R('(SUM(v) / COUNT(v))', 1)} AS mean, COUNT(v) AS n FROM x
            WHERE Meter_ID IS NOT NULL GROUP BY 1""",
        ),
        "F8_group_features_null_time": using(
            "readings",
            f"""WITH t AS (SELECT * REPLACE (CASE WHEN _seq % 20 = 0 THEN NULL ELSE {TS} END AS {TS},
            CASE WHEN _seq % 70 = 0 THEN NULL ELSE Meter_ID END AS Meter_ID) FROM readings)
            SELECT r._seq, md AS meter_daily_consumption_kWh, zh AS zone_hourly_consumption_kWh,
            ma AS meter_avg_power_kW, za AS zone_avg_power_kW FROM t r {_group_totals('t')}""",
        ),
        "ST12_gap_alerts": using(            "readings",
            f"""WITH n AS (SELECT Meter_ID, {TS} AS a, LEAD({TS}) OVER (PARTITION BY Meter_ID ORDER BY {TS}) AS b
            FROM readings), g AS (SELECT *, date_diff('minute', a, b) AS m FROM n)
            SELECT Meter_ID, a AS expected_time, b AS actual_time, m AS time_gap_minutes,
            CASE WHEN m > 15 THEN 'Missing readings' ELSE 'Duplicate period' END AS gap_type FROM g WHERE m <> 15""",
        ),
    }


def all_sql() -> dict[str, str]:
    return {
        **_cleaning(),
        **_features(),
        **_validation(),
        **_aggregates(),
        **_analyses(),
        **_streams(),
    }
