"""Shape the commerce-like test tables into the six raw, all-text tables.

Every value is derived from the keys of the given tables, including the dirt: case, blanks,
sentinels, unknown parents, scores out of range, reversed times and exact copies.
"""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..schemas import Domain

BOUND_DOMAIN = Domain(
    snapshot=dt.date(2001, 8, 2),
    regions=("Africa", "America", "Asia", "Europe", "Middle East"),
    return_window_hours=8,
    id_patterns={
        "facilities": "F[0-9]{3}", "departments": "D[0-9]{6}", "patients": "P[0-9]{7}",
        "referrals": "R[0-9]{7}", "appointments": "A[0-9]{11}", "ed_visits": "V[0-9]{7}",
    },
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pad(expr: str, width: int) -> str:
    """Zero-padded key that never cuts digits off a longer key."""
    text = f"cast({expr} as string)"
    return f"lpad({text}, greatest({width}, length({text})), '0')"


def _with_copies(df: DataFrame, copied: str) -> DataFrame:
    """Rows matching ``copied`` appear twice; the input is read once."""
    copies = F.sequence(F.lit(1), F.when(F.expr(copied), 2).otherwise(1))
    return df.withColumn("__copy", F.explode(copies)).drop("__copy")


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "k")
    regions = table(spark, sf_dir, "region")
    rows = _with_copies(nation, "k % 8 = 3").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.selectExpr(
        f"case when k % 5 = 0 then concat(' f', {_pad('k', 3)}, ' ') else concat('F', {_pad('k', 3)}) end as facility_id",
        "concat(n_name, ' base-hospital') as facility_name",
        "case k % 4 when 0 then upper(r_name) when 1 then concat('  ', lower(r_name), ' ') else r_name end "
        "as hospital_region",
        "concat('CITY ', k) as city",
        "case k % 3 when 0 then 'tertiary hospital' when 1 then 'Regional Hospital' else 'community hospital ' end "
        "as facility_type",
        "case k % 9 when 4 then 'n/a' when 5 then '0' else cast(100 + 10 * k as string) end as bed_capacity",
    )


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_copies(table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "s"), "s % 20 = 7")
    named = rows.selectExpr(
        "*",
        "element_at(array('Cardiology', 'Orthopaedics', 'General Surgery', 'Gastroenterology', 'Respiratory', "
        "'Neurology', 'Dermatology', 'ENT'), cast(s % 8 as int) + 1) as name",
    )
    return named.selectExpr(
        f"concat('D', {_pad('s', 6)}) as department_id",
        f"concat('F', {_pad('s_nationkey', 3)}) as facility_id",
        "case when s % 6 = 5 then concat(' ', lower(name), ' ') else name end as department_name",
        "case when s % 8 in (1, 2, 7) then 'Surgical' else 'medical' end as specialty_group",
        "cast(300 + 30 * (s % 8) as string) as routine_target_days",
        "cast(100 + 20 * (s % 8) as string) as urgent_target_days",
        "cast(20 + 5 * (s % 3) as string) as appointment_wait_target_mins",
    )


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_copies(table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "p"), "p % 30 = 6")
    return rows.selectExpr(
        f"concat(if(p % 10 = 3, ' p', 'P'), {_pad('p', 7)}) as patient_id",
        "case p % 40 when 1 then 'n/a' when 2 then '1899-12-31' when 4 then '2030-01-01' "
        "else cast(date_add(date'1930-01-01', cast((p * 7919) % 24000 as int)) as string) end "
        "as date_of_birth",
        "case c_mktsegment when 'MACHINERY' then 'female' when 'BUILDING' then 'M' "
        "when 'AUTOMOBILE' then ' Gender-Diverse ' when 'HOUSEHOLD' then 'Unknown' else 'MALE' end as gender",
        "case p % 11 when 0 then '' when 1 then 'N/A' when 2 then 'maori' when 3 then 'PACIFIC' when 4 then 'Asian' "
        "when 5 then ' other' else 'European' end as ethnicity",
        "concat('city ', c_nationkey) as city",
        "cast(p % 7 as string) as deprivation_quintile",
        "cast(date_add(date'1996-01-01', cast(p % 1000 as int)) as string) as enrolment_date",
    )


def referrals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o"))
        .agg(
            F.min("l_shipdate").cast("date").alias("fa"),
            F.max("l_shipdate").cast("date").alias("cl"),
            F.min("l_suppkey").alias("dep"),
        )
    )
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as o", "o_custkey", "o_orderstatus", "o_orderpriority", "cast(o_orderdate as date) as received"
    )
    rows = _with_copies(orders.join(lines, "o", "left"), "o % 50 = 9")
    return rows.selectExpr(
        f"concat('R', {_pad('o', 7)}) as referral_id",
        "case when o % 97 = 0 then 'P9999999' when o % 89 = 0 then '' "
        f"when o % 13 = 5 then concat(' p', {_pad('o_custkey', 7)}) else concat('P', {_pad('o_custkey', 7)}) end "
        "as patient_id",
        f"concat('D', {_pad('dep', 6)}) as department_id",
        "cast(received as string) as referral_date",
        "case o_orderpriority when '1-URGENT' then 'Urgent' when '2-HIGH' then 'Semi-Urgent' when '5-LOW' then 'Routine' "
        "when '3-MEDIUM' then 'routine ' else '' end as urgency",
        "case o_orderstatus when 'O' then element_at(array('open', 'Waiting ', 'BOOKED'), cast(o % 3 as int) + 1) "
        "when 'P' then if(o % 2 = 0, 'waiting', 'Cancelled') else if(o % 5 = 0, 'decline', 'completed') end "
        "as referral_status",
        "case when o % 3 = 2 or fa is null then '' when o % 10 = 0 then cast(fa as string) "
        "else cast(date_add(received, abs(datediff(fa, received)) % 600) as string) end "
        "as first_appointment_date",
        "case when o % 4 = 1 then cast(cl as string) else '' end as closed_date",
        "element_at(array('gp', 'self-referral', 'ED '), cast(o % 3 as int) + 1) as referral_source",
        "cast(o % 8 as string) as priority_score",
    )


# Order in which the lines of an (order, line number) pair are numbered; lines equal in all of it are interchangeable.
LINE_ORDER = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
)


def appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*LINE_ORDER)
    # Dealt by order once, lines are numbered and meet their order where they are.
    lines = table(spark, sf_dir, "lineitem").where("l_orderkey is not null").repartition("l_orderkey").select(
        "l_orderkey", "l_linenumber", *LINE_ORDER, F.row_number().over(pair).alias("repeat")
    )
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey as l_orderkey", "o_custkey")
    rows = _with_copies(lines.join(orders, "l_orderkey"), "l_orderkey % 50 = 9").selectExpr(
        "*", "timestampadd(HOUR, l_linenumber + 8, l_shipdate) as scheduled"
    )
    arrived = rows.selectExpr(
        "*", "if(l_returnflag = 'A' and l_partkey % 50 <> 0, timestampadd(MINUTE, -5, scheduled), null) as arrived"
    )
    return arrived.selectExpr(
        f"concat('A', {_pad('l_orderkey * 10 + l_linenumber', 8)}, {_pad('repeat', 3)}) as appointment_id",
        f"concat('P', {_pad('o_custkey', 7)}) as patient_id",
        f"if(l_orderkey % 101 = 0, 'D999999', concat('D', {_pad('l_suppkey', 6)})) as department_id",
        "case when l_linenumber = 1 then '' when l_orderkey % 103 = 0 then 'R9999999' "
        f"else concat('R', {_pad('l_orderkey', 7)}) end as referral_id",
        "cast(scheduled as string) as scheduled_datetime",
        "cast(arrived as string) as check_in_time",
        "cast(timestampadd(MINUTE, cast(l_quantity as int) - 6, arrived) as string) as seen_time",
        "case concat(l_returnflag, l_linestatus) when 'AF' then 'completed' when 'AO' then 'Completed ' "
        "when 'NF' then 'no-show' when 'NO' then 'scheduled' when 'RF' then 'cancelled' else 're-scheduled' end "
        "as appointment_status",
        "element_at(array('first specialist assessment', 'Follow-up', 'PROCEDURE', ' telehealth'), "
        "cast(l_suppkey % 4 as int) + 1) as appointment_type",
        "element_at(array('referral team', 'Phone', 'PATIENT PORTAL', ' clinic'), cast(l_partkey % 4 as int) + 1) "
        "as booking_channel",
    )


def ed_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id as e", "user_id", "event_type", "value",
        "cast(date_trunc('second', ts) as timestamp_ntz) as arrival",
        "cast(get_json_object(props, '$.k') as int) as k",
    )
    rows = _with_copies(events, "e % 40 = 11").selectExpr(
        "*",
        "case when e % 45 = 0 then null when e % 60 = 7 then timestampadd(HOUR, -1, arrival) "
        "else timestampadd(SECOND, cast(floor(value * 60) as int), arrival) end as left_at",
    )
    return rows.selectExpr(
        f"concat('V', {_pad('e', 7)}) as visit_id",
        f"if(e % 61 = 0, 'P9999999', concat('P', {_pad('user_id', 7)})) as patient_id",
        f"if(e % 71 = 0, 'F999', concat('F', {_pad('e % 25', 3)})) as facility_id",
        "cast(arrival as string) as arrival_time",
        "cast(e % 7 as string) as triage_category",
        "coalesce(cast(left_at as string), '') as discharge_time",
        "case event_type when 'view' then 'discharged' when 'click' then 'Discharged ' when 'purchase' then 'admitted' "
        "when 'signup' then 'TRANSFERRED' else 'left before treatment' end as disposition",
        "case when event_type = 'purchase' then if(e % 37 = 0, 'No', 'Yes') when e % 41 = 0 then 'YES' else 'no' end "
        "as admitted_flag",
        "element_at(array('injury', 'Respiratory', 'CARDIAC', 'abdominal', ' neurological', 'infection', 'other'), "
        "k % 7 + 1) as presenting_group",
    )


BINDINGS = {
    "facilities": facilities, "departments": departments, "patients": patients, "referrals": referrals,
    "appointments": appointments, "ed_visits": ed_visits,
}

# Extra rows for the profiling and rule checks: kinds of damage the derived rows do not show.
DAMAGED_ROWS: dict[str, list[tuple[str | None, ...]]] = {
    "facilities": [
        ("", "No Id Hospital", "AFRICA", "City 90", "regional hospital", "10"),
        ("unknown", "Unknown Id Hospital", "ASIA", "City 91", "regional hospital", "-5"),
        ("X12", "Odd Id Hospital", "ATLANTIS", "City 92", "field clinic", None),
        ("F001", "Second Name", "ASIA", "City 93", "Regional Hospital", "20"),
        ("F901", "L" * 101, "EUROPE", "City 94", "Regional Hospital", "30"),
    ],
    "departments": [
        (None, "F001", "Cardiology", "medical", "90", "20", "30"),
        ("n/a", "", "Cardiology", "medical", "90", "20", "30"),
        ("D0X", "F998", "odd unit", "Dental", "30", "60", "0"),
        ("D000001", "F003", "cardiology", "medical", "x", "20", ""),
    ],
    "patients": [
        ("", "1990-01-01", "female", "asian", "city 1", "3", "1999-01-01"),
        ("unknown", "2001-13-45", "male", "Other", "city 2", "na", "1999-01-01"),
        ("n/a", "1980-05-05", "f", "martian", "city 3", "x", "1999-01-01"),
        ("X12", "1999-06-01", "male", "Asian", "city 4", "9", "1998-01-01"),
        ("P0000001", "1970-01-01", "female", "Asian", "city 5", "2", "1999-01-01"),
        ("P9000001", "1970-01-01", "female", "Asian", "c" * 61, "2", "1999-01-01"),
        ("P9000002", None, "female", "Asian", None, "2", "2031-01-01"),
        ("P9000003", "19700301", "female", "Asian", "city 6", "2", "1 Mar 1999"),
        ("P9000004", "Mar 5, 1971", "male", "Asian", "city 7", "2", "in spring"),
    ],
    "referrals": [
        ("", "P0000001", "D000001", "2000-01-01", "urgent", "open", None, None, "gp", "3"),
        ("n/a", "P0000001", "D000001", "2000-01-01", "urgent", "open", None, None, "gp", "na"),
        ("R12", None, "D000001", "2000-01-01", "urgent", "open", None, None, "gp", "x"),
        ("R0000002", "P0000003", "D000002", "2000-02-30", "asap", "lost", None, None, None, "2"),
        ("R9000001", "P0000005", "D000003", None, "routine", "waiting", "2000-01-05", None, "s" * 41, "1"),
        ("R9000002", "P0000005", "D000003", "20000301", "routine", "completed", "5 Mar 2000", "2000/3/9", "gp", "1"),
        ("R9000003", "P0000005", "D000003", " 1 Mar 2000 ", "routine", "waiting", "soon", "31 Feb 2000", "gp", "1"),
        ("R9000004", "P0000005", "D000003", "Mar 1, 2000", "routine", "waiting", "unknown", "n/a", "gp", "1"),
    ],
    "appointments": [
        ("", "P0000001", "D000001", "", "2000-01-01 09:00:00", None, None, "scheduled", "procedure", "phone"),
        ("X12", "P0000001", "D000001", "", None, None, None, "vanished", "checkup", "fax"),
        ("A00000011", "P0000002", None, "", "2000-01-01 09:00:00", None, None, "scheduled", "procedure", "phone"),
        ("A90000001", "P0000002", "D000001", "", "20000301 09:00:00", "1 Mar 2000 08:55", "1 Mar 2000 09:10:30", "completed", "procedure", "phone"),
        ("A90000002", "P0000002", "D000001", "", "2000/3/1", "at noon", "25:00", "completed", "procedure", "phone"),
    ],
    "ed_visits": [
        ("", "P0000001", "F001", "2000-01-01 09:00:00", "3", "2000-01-01 10:00:00", "discharged", "no", "injury"),
        ("V12", "P0000001", "F001", None, "x", None, None, "maybe", "aliens"),
        ("V0000001", None, "F002", "2000-01-01 09:00:00", "na", "2000-01-01 08:00:00", "admitted", "yes", "other"),
        ("V9000001", "P0000001", "F002", "1 Mar 2000 09:00", "3", "20000301 10:30:00", "discharged", "no", "other"),
        ("V9000002", "P0000001", "F002", "2000-03-01T09:00", "3", "later", "discharged", "no", "other"),
    ],
}


def damaged_rows(spark: SparkSession, name: str) -> DataFrame:
    columns = [pa.array(list(values), pa.string()) for values in zip(*DAMAGED_ROWS[name])]
    return spark.createDataFrame(pa.table(columns, names=schemas.RAW_COLUMNS[name]))


#: Text that a careless CSV reader changes, put into the second column of a row that is otherwise empty; fixed values.
AWKWARD_TEXTS = ('a "quoted" word', "one, two", "back\\slash", "\\", 'line\nbreak, "both"', " kept ", "''")


def awkward_rows(spark: SparkSession, name: str) -> DataFrame:
    columns = schemas.RAW_COLUMNS[name]
    rows = [[f"Q{i}", text] + [None] * (len(columns) - 2) for i, text in enumerate(AWKWARD_TEXTS)]
    return spark.createDataFrame(pa.table([pa.array(list(v), pa.string()) for v in zip(*rows)], names=columns))
