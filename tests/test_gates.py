"""One write per clean table: counts, verdicts, clustering, and how often the raw rows are read."""

import pytest
from pyspark.sql import functions as F

from opsward import pipeline, schemas
from opsward.plans import constraints, gates, validation
from opsward.plans.constraints import RuleViolation
from opsward.schemas import Domain
from opsward.sources.layers import LAYOUTS, Layers, layout_order

TABLE = "referrals"

RAW = {
    "facilities": ["F001,Central,Northern,Auckland,Tertiary Hospital,480", "F001,Central,northern ,Auckland,Tertiary Hospital,480"],
    "departments": ["D001,F001,Cardiology,Medical,90,21,30"],
    "patients": ["P000001,1980-01-01,Female,European,Auckland,2,2020-01-01", "P000002,n/a,m,,Auckland,7,2020-01-01"],
    "referrals": ["R0000001,P000001,D001,2026-07-25,Urgent,Open,,,gp,1", "R0000003,P000009,D001,2026-03-01,x,Completed,2026-03-20,2026-04-01,gp,9"],
    "appointments": ["A0000001,P000001,D001,,2026-05-01 09:00:00,2026-05-01 08:50:00,2026-05-01 09:30:00,completed,follow-up,phone"],
    "ed_visits": ["V0000001,P000001,F001,2026-05-01 01:00:00,3,2026-05-01 05:00:00,Discharged,no,injury"] * 3,
}


def raw_tables(spark):
    return {t: spark.createDataFrame([[v or None for v in line.split(",")] for line in lines], schemas.raw_schema(t)) for t, lines in RAW.items()}


def referrals(spark, n=2000):
    """Clean referrals of which every tenth has no status, two share a key, and one is too long."""
    ids = F.when(F.col("id") == 7, "R0000009").otherwise(F.concat(F.lit("R"), F.lpad(F.col("id").cast("string"), 7, "0")))
    given = {
        "referral_id": F.when(F.col("id") == 5, F.lit("R000000000000005")).otherwise(ids),
        "department_id": F.concat(F.lit("D00"), (F.col("id") % 7).cast("string")),
        "referral_date": F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 200).cast("int")),
        "referral_status": F.when(F.col("id") % 10 != 0, "Open"),
        "referral_source": F.lit("Gp"),
        **{f: F.col("id") % 4 == 0 for f in schemas.QUALITY_FLAGS[TABLE]},
    }
    return spark.range(n).select(*[given.get(c, F.lit(None)).alias(c) for c in schemas.clean_columns(TABLE)])


@pytest.mark.parametrize("quarantine", [False, True])
def test_counts_equal_scans_and_rows_split(spark, tmp_path, quarantine):
    layers, rules = Layers(spark, str(tmp_path / "base")), constraints.row_rules(Domain())
    df = referrals(spark)
    gated = gates.write_gated(layers, TABLE, df, rules, quarantine, layout_order(*LAYOUTS[TABLE]))
    checks = gates.store_checks(layers, TABLE, gated)
    wanted = constraints.evaluate({TABLE: df}, [r for r in rules if r.table == TABLE])
    assert sorted(map(str, gates.stored_rules(checks).collect())) == sorted(map(str, wanted.collect()))
    assert gated.found["rows", "all"] == 2000
    stored = layers.read("clean", TABLE)
    if not quarantine:
        assert stored.count() == 2000 == gated.left["rows", "all"]
        with pytest.raises(RuleViolation, match=r"referrals not_null referral_status: 200"):
            gates.require_none(TABLE, gated)
        flags = validation.count_rules(stored, TABLE, {f: F.col(f) for f in schemas.QUALITY_FLAGS[TABLE]}, "flagged_rows")
        assert sorted(map(str, gates.stored_flags(checks).collect())) == sorted(map(str, flags.withColumnRenamed("rule_name", "flag_name").collect()))
        return
    rejected = layers.read("clean_rejected", TABLE)
    reasons = {r[0][0]: r[1] for r in rejected.groupBy("broken_rules").count().collect()}
    assert reasons == {"not_null: referral_status": 200, "max_length: referral_id <= 12": 1, "primary_key: repeated": 2}
    assert stored.count() == 1797 and constraints.primary_keys({TABLE: stored}).first().status == "PASS"
    sound, _ = constraints.quarantine(TABLE, df, rules)
    assert sorted(map(str, stored.collect())) == sorted(map(str, sound.collect()))
    assert gated.left["not_null", "referral_status"] == 0 and gates.stored_rules(checks, "in_clean").where("status = 'FAIL'").count() == 0


@pytest.mark.parametrize("quarantine", [False, True])
def test_clustering_survives(spark, tmp_path, quarantine):
    """Files of the sound rows cover ranges of months that follow each other."""
    layers = Layers(spark, str(tmp_path / "base"))
    df = referrals(spark).where("referral_id <> 'R0000009'")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        gates.write_gated(layers, TABLE, df, constraints.row_rules(Domain()), quarantine, layout_order(*LAYOUTS[TABLE]))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    month = F.trunc("referral_date", "month")
    files = layers.read("clean", TABLE).groupBy(F.input_file_name().alias("file")).agg(F.min(month).alias("a"), F.max(month).alias("b"))
    ranges = sorted((r.a, r.b) for r in files.collect())
    assert len(ranges) > 1 and all(left[1] <= right[0] for left, right in zip(ranges, ranges[1:]))


@pytest.mark.parametrize("rows", ["none", "all rejected"])
def test_empty_parts_can_be_read(spark, tmp_path, rows):
    layers = Layers(spark, str(tmp_path / "base"))
    df = referrals(spark, 50).withColumn("referral_status", F.lit(None).cast("string"))
    df = df.limit(0) if rows == "none" else df
    gated = gates.write_gated(layers, TABLE, df, constraints.row_rules(Domain()), True)
    assert gated.clean.count() == 0 and layers.read("clean_rejected", TABLE).count() == df.count()
    assert gated.clean.columns == schemas.clean_columns(TABLE)


@pytest.mark.parametrize("mode", pipeline.MODES)
def test_raw_rows_are_read_once(spark, tmp_path, monkeypatch, mode):
    """Cleaning, rules, flags, quarantine and layout read every raw row once."""
    layers, domain = Layers(spark, str(tmp_path / "base")), Domain()
    raw = raw_tables(spark)
    for table, df in raw.items():
        layers.write("raw", table, df)
    counted = {t: spark.sparkContext.accumulator(0) for t in raw}
    plain = Layers.read

    def read(self, layer, table):
        df = plain(self, layer, table)
        if layer != "raw":
            return df
        seen = counted[table]

        def watch(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return df.mapInArrow(watch, df.schema)

    monkeypatch.setattr(Layers, "read", read)
    pipeline.build_clean(layers, domain, mode)
    assert {t: n.value for t, n in counted.items()} == {t: df.count() for t, df in raw.items()}


def test_report_reads_the_stored_counts(spark, tmp_path):
    layers, domain = Layers(spark, str(tmp_path / "base")), Domain()
    for table, df in raw_tables(spark).items():
        layers.write("raw", table, df)
    pipeline.build_clean(layers, domain, "report")
    clean = pipeline.open_clean(layers)
    checks = pipeline.open_checks(layers)
    tables = {t: clean[t] for t in schemas.TABLES}
    counted = gates.stored_rules(checks).where("rule_kind <> 'readable'")  # stored rows no longer tell what was unreadable
    assert sorted(map(str, counted.collect())) == sorted(map(str, constraints.evaluate(tables, constraints.row_rules(domain)).collect()))
    assert sorted(map(str, gates.stored_flags(checks).collect())) == sorted(map(str, validation.flag_totals(clean).collect()))
    filled = {(r.table_name, r.column_name): r for r in gates.stored_completeness(checks).collect()}
    found = validation.completeness(clean["patients"], "ethnicity").first()
    assert (filled["patients", "ethnicity"].total_rows, filled["patients", "ethnicity"].missing_rows) == (found.total_rows, found.missing_rows)
    assert "completeness" in pipeline.report({t: clean[t] for t in schemas.TABLES}, clean, domain, checks)


def test_other_forms_are_read_and_rubbish_is_stopped_or_set_aside(spark, tmp_path):
    layers, domain = Layers(spark, str(tmp_path / "base")), Domain()
    raw = raw_tables(spark)
    extra = [
        ("R0000010", "P000001", "D001", "20260301", "Urgent", "Open", "1 Mar 2026", "2026/3/9", "gp", "1"),
        ("R0000011", "P000001", "D001", "Mar 2, 2026", "Urgent", "Open", "soon", "n/a", "gp", "1"),
        ("R0000011", "P000001", "D001", "2026-03-02", "Urgent", "Open", "", "", "gp", "1"),  # one row with the one above
    ]
    raw["referrals"] = raw["referrals"].unionByName(spark.createDataFrame(extra, schemas.raw_schema("referrals")))
    for table, df in raw.items():
        layers.write("raw", table, df)
    with pytest.raises(RuleViolation, match="referrals readable first_appointment_date: 1"):
        pipeline.build_clean(layers, domain)
    clean = pipeline.build_clean(layers, domain, "quarantine", clustered=False)
    read = {r.referral_id: (str(r.referral_date), str(r.first_appointment_date), str(r.closed_date)) for r in clean["referrals"].collect()}
    assert read["R0000010"] == ("2026-03-01", "2026-03-01", "2026-03-09") and "R0000011" not in read
    rejected = layers.read("clean_rejected", "referrals").collect()
    assert [(r.referral_id, r.broken_rules) for r in rejected] == [("R0000011", ["readable: first_appointment_date"])]
    plain = Domain(date_formats=(), time_formats=())
    with pytest.raises(RuleViolation, match="readable referral_date: 2"):
        pipeline.build_clean(layers, plain, clustered=False)


def test_a_clean_table_is_written_in_methods_that_the_jvm_compiles(spark, tmp_path, monkeypatch):
    key, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(key, None)
    monkeypatch.setattr(gates.Layers, "root", lambda self, layer, table: seen.append(spark.conf.get(key)) or f"{tmp_path}/{layer}/{table}")
    empty = spark.createDataFrame([], schemas.CLEAN_DDL["facilities"])
    gates.write_gated(gates.Layers(spark, str(tmp_path)), "facilities", empty, [])
    assert seen[0] == "8000" and spark.conf.get(key, None) == before
