"""Reading and writing of layers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from opsward import schemas
from opsward.sources.layers import Layers, MalformedInput, broken_lines, layout, load_raw, preview, read_raw, refresh_stats, row_counts
from opsward.plans import mappings


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "facilities.csv"
    header = ",".join(schemas.RAW_COLUMNS["facilities"])
    lines = ["﻿" + header, 'F001,"Name, with comma", northern ,City,Regional Hospital,10', 'F002,"",,City,,n/a']
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_read_raw_keeps_text_as_received(spark, csv_file):
    first, second = read_raw(spark, csv_file, "facilities").orderBy("facility_id").collect()
    assert tuple(first) == ("F001", "Name, with comma", " northern ", "City", "Regional Hospital", "10")
    assert second.facility_name == "" and second.hospital_region is None and second.bed_capacity == "n/a"


def test_read_raw_takes_doubled_quotes_and_backslashes(spark, tmp_path):
    columns = schemas.raw_schema("facilities").names
    values = ['F1', 'St "Mary" Hospital, North', "Ward A\\"] + ["x"] * (len(columns) - 3)
    path = tmp_path / "facilities_raw.csv"
    path.write_text(",".join(columns) + "\n" + ",".join('"' + v.replace('"', '""') + '"' for v in values) + "\n")
    assert list(read_raw(spark, str(path), "facilities").first()) == values


def _csv(path, header, *lines):
    path.write_text("\n".join([",".join(header), *lines]) + "\n", encoding="utf-8")
    return str(path)


def test_headers_are_a_contract(spark, tmp_path):
    columns = schemas.raw_schema("facilities").names
    line = ",".join("abcdef")
    assert read_raw(spark, _csv(tmp_path / "right.csv", columns, line), "facilities").count() == 1
    for name, header in {"swapped": [columns[1], columns[0], *columns[2:]], "short": columns[:-1], "other": ["x", *columns[1:]]}.items():
        with pytest.raises(Exception, match="(?i)header"):
            read_raw(spark, _csv(tmp_path / f"{name}.csv", header, line), "facilities").collect()


@pytest.mark.parametrize("multiline", [False, True])
def test_broken_lines_stop_the_load_or_are_set_aside(spark, tmp_path, multiline):
    columns, layers = schemas.raw_schema("facilities").names, Layers(spark, str(tmp_path / "base"))
    path = _csv(tmp_path / "f.csv", columns, "F1,a,b,c,d,1", "F2,too,few", "F3,a,b,c,d,3,too many", "F4,a,b,c,d,4")
    with pytest.raises(MalformedInput, match="2 lines"):
        load_raw(layers, path, "facilities", multiline)
    stored = load_raw(layers, path, "facilities", multiline, on_broken="quarantine")
    assert sorted(r.facility_id for r in stored.collect()) == ["F1", "F4"] and stored.columns == columns
    assert sorted(r[0].strip() for r in broken_lines(layers, "facilities").collect()) == ["F2,too,few", "F3,a,b,c,d,3,too many"]
    clean = _csv(tmp_path / "g.csv", columns, "F5,a,b,c,d,1")
    assert load_raw(layers, clean, "facilities", multiline).count() == 1 and broken_lines(layers, "facilities").count() == 0
    assert load_raw(layers, _csv(tmp_path / "h.csv", columns, "all,broken"), "facilities", multiline, "quarantine").count() == 0
    with pytest.raises(ValueError):
        load_raw(layers, clean, "facilities", on_broken="ignore")


def test_line_breaks_inside_quotes(spark, tmp_path):
    columns, layers = schemas.raw_schema("facilities").names, Layers(spark, str(tmp_path / "base"))
    path = _csv(tmp_path / "f.csv", columns, 'F1,"two\nlines, ""quoted""",b,c,d,1', "F2,a,b,c,d,2")
    rows = {r.facility_id: r.facility_name for r in load_raw(layers, path, "facilities", multiline=True).collect()}
    assert rows == {"F1": 'two\nlines, "quoted"', "F2": "a"}
    with pytest.raises(MalformedInput):
        load_raw(layers, path, "facilities")


def test_load_raw_twice_does_not_duplicate(spark, csv_file, tmp_path):
    layers = Layers(spark, str(tmp_path / "layers"))
    for _ in range(2):
        stored = load_raw(layers, csv_file, "facilities")
    assert stored.count() == 2
    assert row_counts({"facilities": stored}).first().total_rows == 2
    assert preview(stored, 1).first().facility_id == "F001"
    with pytest.raises(ValueError):
        layers.path("bronze", "facilities")


def test_layout_clusters_by_month_and_key(spark, tmp_path):
    start = dt.date(2026, 1, 1)
    data = [(f"D{i % 7}", start + dt.timedelta(days=i % 360), f"P{i}") for i in range(2000)]
    df = spark.createDataFrame(data, "department_id string, referral_date date, patient_id string")
    clustered = layout(df, "referral_date", ["department_id", "referral_date"], partitions=6)
    ranges = (
        clustered.groupBy(F.spark_partition_id().alias("p"))
        .agg(F.min(F.trunc("referral_date", "month")).alias("a"), F.max(F.trunc("referral_date", "month")).alias("b"))
        .orderBy("a", "b").collect()
    )
    assert sum(1 for _ in ranges) > 1
    assert all(left.b <= right.a for left, right in zip(ranges, ranges[1:]))
    assert clustered.count() == 2000


def test_refresh_stats(spark):
    spark.sql("DROP TABLE IF EXISTS stats_check")
    mappings.as_table(spark, mappings.CATEGORY_RULES).write.saveAsTable("stats_check")
    refresh_stats(spark, "stats_check")
    described = {r.info_name: r.info_value for r in spark.sql("DESCRIBE EXTENDED stats_check mapping_group").collect()}
    assert described["distinct_count"] == "3"
    spark.sql("DROP TABLE stats_check")
