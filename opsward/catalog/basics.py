"""Registered single-operator queries, each over whole tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as fn
from .. import schemas
from ..operators import joins, keys, shares
from ..operators.stacking import unpivot_text
from ..plans import profiling as pf
from ..plans import questions as q
from ..plans import views
from ..plans.cleaning import NAME_EXCEPTIONS, read_dates
from ..sources import statistics
from ..sources.access import ACCESS_PATHS
from ..sources.layers import preview, row_counts
from .oracle import SNAPSHOT, initcap, key, label, n, n_if, nid, pct, positive, present, score, sentinel, to_date, to_ts, trim, union_all, value_case
from .registry import query


def union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# Sources and sinks

@query("src01_read_raw", "SELECT * FROM csv_referrals")
def _(w):
    """Written as CSV with a header, read back as text; blanks, empty fields, quotes, commas, backslashes and line breaks survive."""
    return w.csv["referrals"]


@query("src03_row_counts", union_all(
    f"SELECT '{t}' AS table_name, {n()} AS total_rows FROM raw_{t}" for t in schemas.TABLES))
def _(w):
    return row_counts(w.raw)


@query("src04_preview", "SELECT * FROM raw_referrals ORDER BY ALL LIMIT 10")
def _(w):
    return preview(w.raw["referrals"], 10)


@query("snk01_write_clean", f"SELECT referral_status, {n()} AS referrals, min(referral_date) AS first_date FROM clean_referrals GROUP BY 1")
def _(w):
    """Reads the stored clean table, which is rebuilt from raw without leaving old rows."""
    return w.clean["referrals"].groupBy("referral_status").agg(
        F.count("*").alias("referrals"), F.min("referral_date").alias("first_date")
    )


_LAYOUT_MONTH = (dt.date(2000, 3, 1), dt.date(2000, 3, 31))


@query("snk05_layout", f"""
SELECT department_id, {n()} AS referrals FROM clean_referrals
WHERE referral_date BETWEEN DATE '{_LAYOUT_MONTH[0]}' AND DATE '{_LAYOUT_MONTH[1]}' GROUP BY 1""")
def _(w):
    """One month of the clustered referrals: min/max statistics skip the other files."""
    return w.clustered["referrals"].where(F.col("referral_date").between(*_LAYOUT_MONTH)).groupBy("department_id").agg(
        F.count("*").alias("referrals")
    )


_ANALYSED = {t: [c for c in cs if c not in ("referral_id", "appointment_id", "visit_id")] for t, cs in statistics.ANALYSED.items()}


@query("snk04_statistics", union_all(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, {n()} AS row_count, {n()} - {n(c)} AS null_count, "
    f"{n(f'DISTINCT {c}')} AS distinct_values, true AS estimate_is_close FROM clean_{t}"
    for t, cs in _ANALYSED.items() for c in cs))
def _(w):
    """What the catalog knows after the clean tables were analysed, and whether its distinct counts are within 15 per cent."""
    for table in schemas.TABLES:
        _ = w.clean[table]
    statistics.refresh(w.layers)
    known = statistics.column_statistics(w.layers, _ANALYSED)
    off = F.abs(F.col("distinct_count") - F.col("exact"))
    return known.join(statistics.distinct_counts(w.layers, _ANALYSED), ["table_name", "column_name"]).select(
        "table_name", "column_name", "row_count", "null_count", F.col("exact").alias("distinct_values"),
        (off <= F.greatest(F.lit(1.0), 0.15 * F.col("exact"))).alias("estimate_is_close"),
    )


_HISTORY = ("P0000007", "P0000011", "P0000052")


@query("snk05b_patient_history", f"""
SELECT patient_id, 'referral' AS event, referral_id AS event_id, referral_date::TIMESTAMP AS happened_at, referral_status AS outcome
FROM clean_referrals WHERE patient_id IN {_HISTORY}
UNION ALL SELECT patient_id, 'appointment', appointment_id, scheduled_datetime, appointment_status FROM clean_appointments WHERE patient_id IN {_HISTORY}
UNION ALL SELECT patient_id, 'ED visit', visit_id, arrival_time, disposition FROM clean_ed_visits WHERE patient_id IN {_HISTORY}""")
def _(w):
    """Everything known of some patients, read from their buckets alone."""
    return q.patient_history(w.clean, _HISTORY)


_PATH_KEYS = {name: (p.table, p.key) for name, p in ACCESS_PATHS.items()}


@query("snk05c_access_paths", union_all(
    f"SELECT '{name}' AS access_path, {n()} AS stored_rows, count(DISTINCT {k})::BIGINT AS keys, 0::BIGINT AS misplaced_rows FROM clean_{t} WHERE {k} IS NOT NULL"
    for name, (t, k) in _PATH_KEYS.items()))
def _(w):
    """Rows and keys of every access path, and rows in another bucket than their key's hash says."""
    return union(
        w.clean[name].placed()
        .agg(F.count("*").alias("stored_rows"), F.count_distinct(key_).alias("keys"), F.count_if("misplaced").alias("misplaced_rows"))
        .select(F.lit(name).alias("access_path"), "*")
        for name, (_, key_) in _PATH_KEYS.items()
    )


# Projections

@query("prj01_project", "SELECT referral_id, facility_city, patient_city, 'referral' AS record_kind FROM v_referral")
def _(w):
    return views.referral_view(w.clean, w.domain).select(
        "referral_id", "facility_city", "patient_city", F.lit("referral").alias("record_kind")
    )


@query("prj02_case_searched", "SELECT referral_id, target_days, backlog_wait_band FROM v_referral")
def _(w):
    return views.referral_view(w.clean, w.domain, {"departments"}).select("referral_id", "target_days", "backlog_wait_band")


@query("prj03_case_simple", f"""
SELECT appointment_type, {value_case('appointment_type', schemas.APPOINTMENT_TYPES)} AS standard_type, booking_channel,
  {value_case('booking_channel', schemas.BOOKING_CHANNELS)} AS standard_channel, {n()} AS records FROM bad_raw_appointments GROUP BY ALL""")
def _(w):
    lists = {"standard_type": ("appointment_type", schemas.APPOINTMENT_TYPES), "standard_channel": ("booking_channel", schemas.BOOKING_CHANNELS)}
    mapped = w.damaged_raw["appointments"].withColumns(
        {name: fn.map_values(F.col(c), {v.lower(): v for v in values}) for name, (c, values) in lists.items()}
    )
    return mapped.groupBy("appointment_type", "standard_type", "booking_channel", "standard_channel").agg(
        F.count("*").alias("records")
    )


@query("prj04_flags", "SELECT appointment_id, attendance_eligible_flag, completed_flag, no_show_flag, wait_time_eligible_flag FROM v_appointment")
def _(w):
    return views.appointment_view(w.clean, w.domain, ()).select(
        "appointment_id", "attendance_eligible_flag", "completed_flag", "no_show_flag", "wait_time_eligible_flag"
    )


# Filters

@query("flt01_compare", """
SELECT referral_id, urgency, priority_score::BIGINT AS priority_score FROM clean_referrals
WHERE (urgency <> 'Routine' AND priority_score >= 3) OR closed_date < DATE '1998-01-01'""")
def _(w):
    urgent = (F.col("urgency") != "Routine") & (F.col("priority_score") >= 3)
    early = F.col("closed_date") < F.lit(dt.date(1998, 1, 1))
    return w.clean["referrals"].where(urgent | early).select("referral_id", "urgency", "priority_score")


@query("flt02_in_notin", f"""
SELECT referral_status, urgency, {n()} AS referrals FROM clean_referrals
WHERE referral_status IN ('Open', 'Waiting', 'Booked') AND urgency NOT IN ('Routine') GROUP BY 1, 2""")
def _(w):
    """A NULL urgency is neither in nor not in the list."""
    kept = F.col("referral_status").isin("Open", "Waiting", "Booked") & ~F.col("urgency").isin("Routine")
    return w.clean["referrals"].where(kept).groupBy("referral_status", "urgency").agg(F.count("*").alias("referrals"))


@query("flt03_between", f"""
SELECT referral_id, ({SNAPSHOT} - referral_date)::BIGINT AS days FROM clean_referrals
WHERE ({SNAPSHOT} - referral_date) BETWEEN 15 AND 60 AND priority_score NOT BETWEEN 2 AND 4""")
def _(w):
    days = fn.days_between(F.lit(w.domain.snapshot), F.col("referral_date"))
    kept = days.between(15, 60) & ~F.col("priority_score").between(2, 4)
    return w.clean["referrals"].where(kept).select("referral_id", days.alias("days"))


@query("flt04_null_tests", "SELECT visit_id FROM clean_ed_visits WHERE facility_id IS NULL AND discharge_time IS NOT NULL")
def _(w):
    return w.clean["ed_visits"].where(F.col("facility_id").isNull() & F.col("discharge_time").isNotNull()).select("visit_id")


@query("flt05_regex", f"""
SELECT patient_id, regexp_full_match(upper({trim('patient_id')}), 'P[0-9]{{6}}[13579]') AS odd_id FROM bad_raw_patients
WHERE NOT regexp_full_match({trim('patient_id')}, 'P[0-9]{{7}}')""")
def _(w):
    patient = F.btrim(F.col("patient_id"))
    odd = fn.matches(F.upper(patient), "P[0-9]{6}[13579]").alias("odd_id")
    return w.damaged_raw["patients"].where(~fn.matches(patient, "P[0-9]{7}")).select("patient_id", odd)


@query("flt06_three_valued", f"""
SELECT {n_if('met_wait_target_flag = TRUE')} AS is_true, {n_if('met_wait_target_flag = FALSE')} AS is_false,
  {n_if('met_wait_target_flag IS NULL')} AS is_unknown, {n_if('coalesce(met_wait_target_flag, FALSE) = FALSE')} AS not_true,
  {n_if('met_wait_target_flag IS NOT DISTINCT FROM NULL')} AS same_as_null FROM v_appointment""")
def _(w):
    met = F.col("met_wait_target_flag")
    return views.appointment_view(w.clean, w.domain, {"departments"}).agg(
        F.count_if(met == F.lit(True)).alias("is_true"), F.count_if(met == F.lit(False)).alias("is_false"),
        F.count_if(met.isNull()).alias("is_unknown"), F.count_if(~fn.flag(met)).alias("not_true"),
        F.count_if(met.eqNullSafe(F.lit(None))).alias("same_as_null"),
    )


# Joins

@query("jn01_star_left", "SELECT appointment_id, department_name, gender FROM v_appointment")
def _(w):
    dims = [
        (w.clean["departments"].select("department_id", "department_name"), "department_id"),
        (w.clean["patients"].select("patient_id", "gender"), "patient_id"),
    ]
    return joins.enrich(w.clean["appointments"], dims).select("appointment_id", "department_name", "gender")


@query("jn02_snowflake", "SELECT appointment_id, department_name, facility_name, hospital_region FROM v_appointment")
def _(w):
    return joins.enrich(w.clean["appointments"], [(q.department_places(w.clean), "department_id")]).select(
        "appointment_id", "department_name", "facility_name", "hospital_region"
    )


@query("jn03_mapping_lookup", f"""
SELECT r.referral_status, m.standard_value, {n()} AS records FROM bad_raw_referrals r
LEFT JOIN mappings m ON m.mapping_group = 'referral_status' AND m.raw_value_normalised = {key('r.referral_status')} GROUP BY 1, 2""")
def _(w):
    keyed = w.damaged_raw["referrals"].select("referral_status", fn.norm_key(F.col("referral_status")).alias("k"))
    mapped = joins.map_by_table(keyed, "k", w.clean["reference_mappings"], "referral_status", "standard_value")
    return mapped.groupBy("referral_status", "standard_value").agg(F.count("*").alias("records"))


@query("jn04_resolve_fk", f"""
SELECT a.appointment_id, d.department_id, r.referral_id, d.department_id IS NULL AS department_id_issue_flag,
  {nid('a.referral_id')} IS NOT NULL AND r.referral_id IS NULL AS referral_id_issue_flag
FROM raw_appointments a LEFT JOIN clean_departments d ON {nid('a.department_id')} = d.department_id
LEFT JOIN clean_referrals r ON {nid('a.referral_id')} = r.referral_id""")
def _(w):
    keyed = w.raw["appointments"].select(
        "appointment_id", fn.norm_id(F.col("department_id")).alias("dk"), fn.norm_id(F.col("referral_id")).alias("rk")
    )
    linked = joins.resolve_fk(keyed, w.clean["departments"], "dk", "department_id", "department_id_issue_flag")
    return joins.resolve_fk(linked, w.clean["referrals"], "rk", "referral_id", "referral_id_issue_flag", optional=True)


@query("jn05_inner", """
SELECT a.appointment_id, r.referral_id, (a.scheduled_datetime::DATE - r.referral_date)::BIGINT AS days_after_referral
FROM clean_appointments a JOIN clean_referrals r ON a.referral_id = r.referral_id""")
def _(w):
    referral = w.clean["referrals"].select("referral_id", "referral_date")
    linked = w.clean["appointments"].select("appointment_id", "referral_id", "scheduled_datetime").join(referral, "referral_id")
    days = fn.days_between(F.col("scheduled_datetime").cast("date"), F.col("referral_date"))
    return linked.select("appointment_id", "referral_id", days.alias("days_after_referral"))


@query("jn06_anti_not_exists", f"""
SELECT a.appointment_id, a.department_id FROM raw_appointments a WHERE {present('a.department_id')} IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM raw_departments d WHERE {nid('d.department_id')} = {nid('a.department_id')})""")
def _(w):
    lost = joins.orphans(w.raw["appointments"], w.raw["departments"], "department_id", "department_id")
    return lost.select("appointment_id", "department_id")


# Aggregations

@query("ag01_global_count", f"SELECT {n()} AS total_rows FROM clean_appointments")
def _(w):
    return w.clean["appointments"].agg(F.count("*").alias("total_rows"))


@query("ag02_group_count", f"SELECT urgency, referral_source, {n()} AS referrals FROM clean_referrals GROUP BY 1, 2")
def _(w):
    return w.clean["referrals"].groupBy("urgency", "referral_source").agg(F.count("*").alias("referrals"))


@query("ag03_count_col", f"SELECT {n('patient_id')} AS with_patient, {n('department_id')} AS with_department, {n('closed_date')} AS closed FROM clean_referrals")
def _(w):
    return w.clean["referrals"].agg(
        F.count("patient_id").alias("with_patient"), F.count("department_id").alias("with_department"),
        F.count("closed_date").alias("closed"),
    )


@query("ag04_count_distinct", f"SELECT {n('DISTINCT patient_id')} AS patients, {n('DISTINCT department_id')} AS departments FROM clean_appointments")
def _(w):
    return w.clean["appointments"].agg(
        F.count_distinct("patient_id").alias("patients"), F.count_distinct("department_id").alias("departments")
    )


@query("ag05_filtered_count", f"""
SELECT referral_status, {n_if('timeline_issue_flag')} AS timeline_issues, {n_if('urgency IS NULL')} AS without_urgency,
  {n_if('priority_score >= 4')} AS high_priority FROM clean_referrals GROUP BY 1""")
def _(w):
    return w.clean["referrals"].groupBy("referral_status").agg(
        F.count_if("timeline_issue_flag").alias("timeline_issues"), F.count_if(F.col("urgency").isNull()).alias("without_urgency"),
        F.count_if(F.col("priority_score") >= 4).alias("high_priority"),
    )


@query("ag06_avg", f"""
SELECT urgency, CASE WHEN count(days_to_first_appointment) = 0 THEN NULL ELSE
  ((200 * sum(days_to_first_appointment) + count(days_to_first_appointment)) // (2 * count(days_to_first_appointment))) / 100::DOUBLE END
  AS average_days FROM v_referral GROUP BY 1""")
def _(w):
    view = views.referral_view(w.clean, w.domain, ())
    return view.groupBy("urgency").agg(fn.avg_2dp(F.col("days_to_first_appointment")).alias("average_days"))


@query("ag07_max", "SELECT presenting_group, max(stay_h) / 100::DOUBLE AS longest_stay FROM v_ed GROUP BY 1")
def _(w):
    view = views.ed_visit_view(w.clean, w.domain, ())
    return view.groupBy("presenting_group").agg(F.max("length_of_stay_hours").alias("longest_stay"))


@query("ag09_safe_pct", f"""
SELECT urgency, {pct('count(*) FILTER (WHERE backlog_over_target_flag)', 'count(backlog_over_target_flag)')} AS over_target_percentage
FROM v_referral GROUP BY 1""")
def _(w):
    """Semi-urgent referrals have no target, so their rate is NULL rather than an error."""
    view = views.referral_view(w.clean, w.domain, {"departments"})
    rate = fn.pct(F.count_if("backlog_over_target_flag"), F.count("backlog_over_target_flag"))
    return view.groupBy("urgency").agg(rate.alias("over_target_percentage"))


@query("ag10_having", f"SELECT patient_id, {n()} AS visits FROM clean_ed_visits GROUP BY 1 HAVING count(*) > 1")
def _(w):
    return keys.duplicate_keys(w.clean["ed_visits"], ["patient_id"]).select(
        "patient_id", F.col("occurrence_count").alias("visits")
    )


@query("ag11_group_expr", f"""
SELECT date_trunc('month', scheduled_datetime)::DATE AS month_start, upper(booking_channel) AS channel, {n()} AS appointments
FROM clean_appointments GROUP BY 1, 2""")
def _(w):
    month, channel = fn.month_of(F.col("scheduled_datetime")), F.upper("booking_channel")
    return w.clean["appointments"].groupBy(month.alias("month_start"), channel.alias("channel")).agg(
        F.count("*").alias("appointments")
    )


# Windows

@query("wn01_lag", "SELECT visit_id, patient_id, arrival_time, previous_discharge_time FROM v_return")
def _(w):
    return q.visits_with_previous_discharge(w.clean).select(
        "visit_id", "patient_id", "arrival_time", "previous_discharge_time"
    )


@query("wn01b_lag_last_known", """
SELECT visit_id, last_value(discharge_time IGNORE NULLS) OVER (PARTITION BY patient_id ORDER BY arrival_time, visit_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_known_discharge FROM clean_ed_visits WHERE patient_id IS NOT NULL""")
def _(w):
    visits = q.visits_with_previous_discharge(w.clean, ignore_nulls=True)
    return visits.select("visit_id", F.col("previous_discharge_time").alias("previous_known_discharge"))


def _ranked(w, order) -> DataFrame:
    monthly = w.clean["referrals"].groupBy(fn.month_of(F.col("referral_date")).alias("month_start")).agg(
        F.count("*").alias("referrals")
    )
    ranked = F.dense_rank().over(Window.partitionBy(F.year("month_start")).orderBy(order))
    return monthly.withColumn("month_rank", ranked)


_monthly = f"SELECT date_trunc('month', referral_date)::DATE AS month_start, {n()} AS referrals FROM clean_referrals GROUP BY 1"


@query("wn02_dense_rank_asc", f"SELECT *, dense_rank() OVER (PARTITION BY year(month_start) ORDER BY referrals)::BIGINT AS month_rank FROM ({_monthly})")
def _(w):
    return _ranked(w, F.col("referrals").asc_nulls_last())


@query("wn03_dense_rank_desc", f"SELECT *, dense_rank() OVER (PARTITION BY year(month_start) ORDER BY referrals DESC)::BIGINT AS month_rank FROM ({_monthly})")
def _(w):
    return _ranked(w, F.col("referrals").desc_nulls_first())


@query("wn04_share_of_total", f"""
SELECT booking_channel, c AS appointments, {pct('c', '(sum(c) OVER ())')} AS share_percentage
FROM (SELECT booking_channel, {n()} AS c FROM clean_appointments GROUP BY 1)""")
def _(w):
    counts = w.clean["appointments"].groupBy("booking_channel").agg(F.count("*").alias("appointments"))
    return shares.share_of_total(counts, "appointments", "share_percentage")


# Sorts, limits and sets

@query("so03_band_order", f"""
SELECT backlog_wait_band, CASE backlog_wait_band WHEN '0-14 days' THEN 1 WHEN '15-30 days' THEN 2 WHEN '31-60 days' THEN 3 ELSE 4 END::BIGINT AS band_position,
  {n()} AS referrals FROM v_referral WHERE backlog_flag GROUP BY 1, 2""")
def _(w):
    backlog = views.referral_view(w.clean, w.domain, ()).where("backlog_flag")
    counts = backlog.groupBy("backlog_wait_band").agg(F.count("*").alias("referrals"))
    position = views.band_order(F.col("backlog_wait_band"))
    return counts.withColumn("band_position", position).orderBy("band_position")


@query("so05_top_n", f"""
SELECT department_id, {n()} AS backlog FROM v_referral WHERE backlog_flag AND department_id IS NOT NULL
GROUP BY 1 ORDER BY backlog DESC, department_id LIMIT 10""")
def _(w):
    backlog = views.referral_view(w.clean, w.domain, ()).where(F.col("backlog_flag") & F.col("department_id").isNotNull())
    counts = backlog.groupBy("department_id").agg(F.count("*").alias("backlog"))
    return shares.top_n(counts, "backlog", ["department_id"], 10)


@query("st01_union_all", f"""
SELECT source, month_start, {n()} AS records FROM (
  SELECT 'referral' AS source, date_trunc('month', referral_date)::DATE AS month_start FROM clean_referrals
  UNION ALL SELECT 'appointment', date_trunc('month', scheduled_datetime)::DATE FROM clean_appointments
  UNION ALL SELECT 'ed visit', date_trunc('month', arrival_time)::DATE FROM clean_ed_visits) GROUP BY 1, 2""")
def _(w):
    facts = {"referral": ("referrals", "referral_date"), "appointment": ("appointments", "scheduled_datetime"),
             "ed visit": ("ed_visits", "arrival_time")}
    parts = [
        w.clean[t].select(F.lit(source).alias("source"), fn.month_of(F.col(c)).alias("month_start"))
        for source, (t, c) in facts.items()
    ]
    return union(parts).groupBy("source", "month_start").agg(F.count("*").alias("records"))


@query("st02_distinct", "SELECT DISTINCT * FROM raw_referrals")
def _(w):
    return keys.exact_dedupe(w.raw["referrals"])


# Scalar functions: every distinct input value of the category columns beside the result

def _cells(w) -> DataFrame:
    return union([unpivot_text(w.damaged_raw[t], t, cs) for t, cs in pf.CATEGORY_COLUMNS.items()])


_cell_rows = union_all(f"SELECT {c} AS raw_value FROM bad_raw_{t}" for t, cs in pf.CATEGORY_COLUMNS.items() for c in cs)


def _over_cells(name: str, results: dict, sqls: dict):
    select = ", ".join(f"{expression} AS {column}" for column, expression in sqls.items())

    def build(w):
        counts = _cells(w).groupBy("raw_value").agg(F.count("*").alias("records"))
        return counts.withColumns({column: make(F.col("raw_value")) for column, make in results.items()})

    query(name, f"SELECT raw_value, {n()} AS records, {select} FROM ({_cell_rows}) GROUP BY raw_value")(build)


_over_cells("fn01_btrim", {"result": F.btrim, "presence": fn.trimmed}, {"result": trim("raw_value"), "presence": present("raw_value")})
_over_cells("fn02_case", {"up": F.upper, "low": F.lower}, {"up": "upper(raw_value)", "low": "lower(raw_value)"})
_over_cells("fn03_initcap", {"result": fn.initcap_words}, {"result": initcap("raw_value")})
_over_cells("fn04_coalesce", {"result": lambda c: F.coalesce(c, F.lit("[NULL]"))}, {"result": "coalesce(raw_value, '[NULL]')"})
_over_cells("fn05_nullif", {"result": lambda c: F.nullif(F.btrim(c), F.lit("Cardiology"))},
            {"result": f"nullif({trim('raw_value')}, 'Cardiology')"})
_over_cells("fn06_concat", {"result": fn.bracketed}, {"result": "'[' || coalesce(raw_value, 'NULL') || ']'"})
_over_cells("cp01_norm_id", {"result": fn.norm_id}, {"result": nid("raw_value")})
_over_cells("cp02_norm_label", {"result": lambda c: fn.norm_label(c, NAME_EXCEPTIONS)},
            {"result": f"CASE WHEN {key('raw_value')} = 'ent' THEN 'ENT' ELSE {label('raw_value')} END"})
_over_cells("cp03_sentinel_null",
            {"result": lambda c: fn.null_sentinels(c, schemas.VALUE_SENTINELS), "missing": lambda c: fn.is_sentinel(c, schemas.VALUE_SENTINELS)},
            {"result": f"CASE WHEN NOT {sentinel('raw_value', schemas.VALUE_SENTINELS)} THEN raw_value END",
             "missing": sentinel("raw_value", schemas.VALUE_SENTINELS)})


@query("fn08_to_date", f"""
SELECT referral_id, {to_date('referral_date')} AS referral_day, {to_date('first_appointment_date')} AS first_day, {to_date('closed_date')} AS closed_day
FROM bad_raw_referrals""")
def _(w):
    days = {"referral_day": "referral_date", "first_day": "first_appointment_date", "closed_day": "closed_date"}
    return w.damaged_raw["referrals"].select("referral_id", *[fn.parse_date(F.col(c), w.domain.date_formats).alias(a) for a, c in days.items()])


@query("fn09_to_timestamp", f"""
SELECT visit_id, {to_ts('arrival_time')} AS arrived_at, {to_ts('discharge_time')} AS left_at FROM bad_raw_ed_visits""")
def _(w):
    read = read_dates("ed_visits", w.domain)
    return w.damaged_raw["ed_visits"].select("visit_id", read["arrival_time"].alias("arrived_at"), read["discharge_time"].alias("left_at"))


@query("fn10_to_int", f"""
SELECT department_id, TRY_CAST({present('routine_target_days')} AS BIGINT) AS routine_days, TRY_CAST({present('urgent_target_days')} AS BIGINT) AS urgent_days
FROM bad_raw_departments""")
def _(w):
    return w.damaged_raw["departments"].select(
        "department_id", fn.parse_integer(F.col("routine_target_days")).alias("routine_days"),
        fn.parse_integer(F.col("urgent_target_days")).alias("urgent_days"),
    )


@query("fn12_ts_to_date", f"SELECT scheduled_datetime::DATE AS scheduled_day, {n()} AS appointments FROM clean_appointments GROUP BY 1")
def _(w):
    day = F.col("scheduled_datetime").cast("date")
    return w.clean["appointments"].groupBy(day.alias("scheduled_day")).agg(F.count("*").alias("appointments"))


@query("fn13_is_valid_date", f"SELECT patient_id, date_of_birth, {to_date('date_of_birth')} IS NOT NULL AS is_date FROM bad_raw_patients")
def _(w):
    valid = fn.parse_date(F.col("date_of_birth"), w.domain.date_formats).isNotNull()
    return w.damaged_raw["patients"].select("patient_id", "date_of_birth", valid.alias("is_date"))


@query("fn14_month", f"SELECT date_trunc('month', arrival_time)::DATE AS month_start, {n()} AS visits FROM clean_ed_visits GROUP BY 1")
def _(w):
    return w.clean["ed_visits"].groupBy(fn.month_of(F.col("arrival_time")).alias("month_start")).agg(F.count("*").alias("visits"))


@query("fn15_year", f"SELECT year(referral_date)::BIGINT AS referral_year, {n()} AS referrals FROM clean_referrals GROUP BY 1")
def _(w):
    return w.clean["referrals"].groupBy(F.year("referral_date").alias("referral_year")).agg(F.count("*").alias("referrals"))


@query("fn16_elapsed", """
SELECT visit_id, ((2 * date_diff('microsecond', arrival_time, discharge_time) + 36000000) // 72000000) / 100::DOUBLE AS hours,
  ((2 * date_diff('microsecond', arrival_time, discharge_time) + 600000) // 1200000) / 100::DOUBLE AS minutes FROM clean_ed_visits""")
def _(w):
    arrival, left = F.col("arrival_time"), F.col("discharge_time")
    return w.clean["ed_visits"].select(
        "visit_id", fn.elapsed_2dp("hour", arrival, left).alias("hours"), fn.elapsed_2dp("minute", arrival, left).alias("minutes")
    )


@query("fn17_month_name", f"SELECT rpad(strftime(referral_date, '%B'), 9, ' ') AS month_name, {n()} AS referrals FROM clean_referrals GROUP BY 1")
def _(w):
    return w.clean["referrals"].groupBy(fn.month_name(F.col("referral_date")).alias("month_name")).agg(F.count("*").alias("referrals"))


@query("fn18_datediff", """
SELECT referral_id, (first_appointment_date - referral_date)::BIGINT AS days_to_first, (closed_date - referral_date)::BIGINT AS days_to_close FROM clean_referrals""")
def _(w):
    start = F.col("referral_date")
    return w.clean["referrals"].select(
        "referral_id", fn.days_between(F.col("first_appointment_date"), start).alias("days_to_first"),
        fn.days_between(F.col("closed_date"), start).alias("days_to_close"),
    )


@query("fn19_interval_add", "SELECT visit_id, discharge_time + INTERVAL 7 DAY AS window_end FROM clean_ed_visits")
def _(w):
    return w.clean["ed_visits"].select("visit_id", (F.col("discharge_time") + F.expr("INTERVAL 7 DAYS")).alias("window_end"))


# Cleaning primitives on typed values

@query("cp06_positive_int", f"SELECT facility_id, bed_capacity AS raw_capacity, {positive('bed_capacity')}::BIGINT AS capacity FROM bad_raw_facilities")
def _(w):
    return w.damaged_raw["facilities"].select(
        "facility_id", F.col("bed_capacity").alias("raw_capacity"), fn.parse_positive_int(F.col("bed_capacity")).alias("capacity")
    )


@query("cp07_score", f"""
SELECT priority_score AS raw_score, ({score('priority_score')})::BIGINT AS score, {n()} AS records FROM bad_raw_referrals GROUP BY 1, 2""")
def _(w):
    return w.damaged_raw["referrals"].groupBy(
        F.col("priority_score").alias("raw_score"), fn.parse_score(F.col("priority_score")).alias("score")
    ).agg(F.count("*").alias("records"))


@query("cp08_date_in_range", f"""
SELECT patient_id, CASE WHEN {to_date('date_of_birth')} BETWEEN DATE '1900-01-01' AND {SNAPSHOT} THEN {to_date('date_of_birth')} END AS birth_date
FROM bad_raw_patients""")
def _(w):
    born = fn.parse_date_in_range(F.col("date_of_birth"), schemas.FIRST_VALID_BIRTH_DATE, w.domain.snapshot, w.domain.date_formats)
    return w.damaged_raw["patients"].select("patient_id", born.alias("birth_date"))


@query("cp09_null_if_before", f"""
SELECT appointment_id, CASE WHEN c IS NULL OR s >= c THEN s END AS kept_without_base, CASE WHEN s >= c THEN s END AS kept_with_base
FROM (SELECT appointment_id, {to_ts('check_in_time')} AS c, {to_ts('seen_time')} AS s FROM raw_appointments)""")
def _(w):
    read = read_dates("appointments", w.domain)
    seen, arrived = read["seen_time"], read["check_in_time"]
    return w.raw["appointments"].select(
        "appointment_id", fn.null_if_before(seen, arrived, keep_without_base=True).alias("kept_without_base"),
        fn.null_if_before(seen, arrived).alias("kept_with_base"),
    )
