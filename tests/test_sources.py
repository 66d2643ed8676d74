import pytest

from quakespark.operators import links as lnk, prepare
from quakespark.sources import tables, text


def write(tmp_path, name, lines):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n")
    return str(path)


PHASES = [
    "# 2020  3  9 10 51 59.99  40.4657 -124.4777   29.78  0.00  0.00  0.00  0.00     100000",
    "B045       7.500  0.844 P",
    "1582       5.370  -0.645 S",
    "# 2020 12 31 23 59 60.00  40.4000 -124.4000   10.00  1.00  0.10  0.20  0.01     7",
    "B045       6.500  1.000 P",
]


def test_phase_file(spark, tmp_path):
    events, picks = text.read_phase_file(spark, write(tmp_path, "p.txt", PHASES))
    rows = events.orderBy("ord").collect()
    assert [r.id for r in rows] == [100000, 7]
    assert str(rows[1].origin_time) == "2021-01-01 00:00:00"
    got = [(r.id, r.sta, r.phase, r.tt, r.weight) for r in picks.orderBy("id", "seq").collect()]
    assert got == [(7, "B045", "P", 6.5, 1.0), (100000, "B045", "P", 7.5, 0.844), (100000, "1582", "S", 5.37, -0.645)]


def test_phase_file_keeps_order_over_many_splits(spark, tmp_path):
    lines = []
    for i in range(3000):
        lines += [PHASES[0][:-6] + f"{i:6d}", PHASES[1]]
    path = write(tmp_path, "big.txt", lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        events, picks = text.read_phase_file(spark, path)
        assert events.rdd.getNumPartitions() > 3
        assert [r.id for r in events.orderBy("ord").collect()] == list(range(3000))
        assert picks.count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_bad_event_line_fails(spark, tmp_path):
    events, _ = text.read_phase_file(spark, write(tmp_path, "bad.txt", ["# 2020 3 9", "B045 7.5 0.8 P"]))
    with pytest.raises(Exception, match="bad event line"):
        events.collect()


def test_short_relocation_lines_drop(spark, tmp_path):
    full = "1 40.0 -124.0 5.0 1 2 3 4 5 6 2020 3 9 10 51 18.67 0.0 3 2 0 0 0.174 -9.000 1"
    path = write(tmp_path, "r.txt", [full, "2 40.1 -124.1 6.0", "3 1"])
    assert [r.id for r in text.read_relocations(spark, path).collect()] == [1]
    assert sorted(r.id for r in text.read_relocations(spark, path, 4).collect()) == [1, 2]


def test_station_file_columns_follow_the_first_line(spark, tmp_path):
    three = text.read_station_file(spark, write(tmp_path, "s3.txt", ["A 40 -124", "B 41 -125 9"])).collect()
    assert [(r.sta, r.elev_m) for r in three] == [("A", 0.0), ("B", 0.0)]
    five = text.read_station_file(spark, write(tmp_path, "s5.txt", ["A 40 -124 100 2"])).collect()
    assert (five[0].elev_m, five[0].model_id) == (100.0, 2)
    with pytest.raises(ValueError):
        text.read_station_file(spark, write(tmp_path, "s2.txt", ["A 40"]))


def test_event_list_with_and_without_fix(spark, tmp_path):
    base = "20200309  10511861   40.4657  -124.4777     29.780   0.00    0.00    0.00   0.00     100000"
    rows = text.read_event_list(spark, write(tmp_path, "e.txt", [base, base.replace("100000", "5") + " 3"])).collect()
    assert {r.id: r.fix for r in rows} == {100000: 0, 5: 3}


def test_station_models(spark, tmp_path):
    path = write(tmp_path, "m.txt", ["1 2", "0.0 5.0 2.9", "3.0 6.0 3.4", "7 1", "0.0 4.0 2.0"])
    rows = text.read_station_models(spark, path).collect()
    assert sorted((r.model_id, r.top) for r in rows) == [(1, 0.0), (1, 3.0), (7, 0.0)]


def test_both_mapping_namings(spark, tmp_path):
    for (number, original), name in zip((("synthetic_id", "original_id"), ("number_id", "event_id")), "ab"):
        path = write(tmp_path, f"{name}.csv", [f"{original},{number}", "x1,100000"])
        assert [tuple(r) for r in tables.read_id_mapping(spark, path).collect()] == [("x1", 100000)]
    other = write(tmp_path, "c.csv", ["a,b", "1,2"])
    assert tables.read_id_mapping(spark, other).count() == 0
    # detections have ids too, but are no mapping; columns may be named
    other = write(tmp_path, "d.csv", ["event_id,template_id", "1,2"])
    assert tables.read_id_mapping(spark, other).count() == 0
    wide = write(tmp_path, "e.csv", ["event_id,run_id,mag", "x1,7,2.5"])
    assert tables.read_id_mapping(spark, wide).count() == 0
    assert [tuple(r) for r in tables.read_id_mapping(spark, wide, number="run_id").collect()] == [("x1", 7)]
    with pytest.raises(ValueError, match="no_id"):
        tables.read_id_mapping(spark, wide, number="no_id")


def test_unknown_phase_and_missing_mapping_fail(spark):
    links = spark.createDataFrame([(1, 2, "X")], "id1 long, id2 long, phase string")
    with pytest.raises(Exception, match="unknown phase"):
        lnk.keep_phases(links, "both").collect()
    ids = spark.createDataFrame([("a", 1)], "original_id string, synthetic_id long")
    with pytest.raises(Exception, match="no id mapping"):
        prepare.required_id(spark.createDataFrame([("b",)], "event_id string"), ids, "event_id", "id").collect()


def test_duplicate_stations_fail_the_job(spark):
    stations = spark.createDataFrame([("A",), ("A",)], "sta string")
    with pytest.raises(Exception, match="twice"):
        lnk.fail_on_rows(stations, lnk.duplicate_stations(stations), "station listed twice").collect()


def test_detections_fall_back_to_all_rows(spark):
    rows = spark.createDataFrame([("a", "a")], "event_id string, template_id string")
    assert prepare.detections_only(rows).count() == 1
