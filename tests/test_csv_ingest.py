import os
import tempfile

import pytest
from pyspark.sql import types as T

from layerkit.sources import literal_path, parse_csv_lines, read_csv_quarantined, read_lines, reject_report

SCHEMA = T.StructType([
    T.StructField("student_id", T.StringType()),
    T.StructField("class_date", T.DateType()),
    T.StructField("module_code", T.StringType()),
    T.StructField("status", T.StringType()),
])
HEADER = "student_id,class_date,module_code,status"


def _write(d, name, lines, crlf=True):
    p = os.path.join(d, name)
    with open(p, "w", newline="") as f:
        f.write(("\r\n" if crlf else "\n").join(lines) + ("\r\n" if crlf else "\n"))
    return p


def _corrupt_fixture():
    # 80 data lines; faults on lines 10, 29, 46, 63, 75 (header is line 1).
    lines = [HEADER]
    for i in range(2, 82):
        lines.append(f"S{i:04d},2026-09-14,DE101,PRESENT")
    lines[9] = "S0010,2026-09-14,DE101,PRESENT,extra"
    lines[28] = "S0029,2026-09-14,DE101,PRESENT,left early"
    lines[45] = "S0046,2026-09-14,DE101"
    lines[62] = "S0063,2026-09-31,DE101,PRESENT"
    lines[74] = "S0075,14/09/2026,DE101,PRESENT"
    return lines


def test_corrupt_file_reject_classes(spark):
    d = tempfile.mkdtemp(prefix="csv-")
    _write(d, "attendance_corrupt.csv", _corrupt_fixture())
    good, rejects = read_csv_quarantined(spark, os.path.join(d, "*.csv"), SCHEMA)
    assert good.count() == 75
    rep = [(r.line, r.error_type, r.column_name) for r in reject_report(rejects).collect()]
    assert rep == [(10, "TOO MANY COLUMNS", None), (29, "TOO MANY COLUMNS", None),
                   (46, "MISSING COLUMNS", "status"), (63, "CAST", "class_date"), (75, "CAST", "class_date")]
    raw = [r.csv_line for r in reject_report(rejects).collect()]
    assert raw[0] == "S0010,2026-09-14,DE101,PRESENT,extra"   # CR trimmed


def test_edge_lines_accept_and_double_fault(spark):
    lines = spark.createDataFrame([
        ("f", 1, HEADER),
        ("f", 2, "S1,2026-09-07,DE101,PRESENT,"),          # trailing empty extra field: accepted
        ("f", 3, 'S2,2026-09-07,"A,B",PRESENT'),            # quoted comma: accepted
        ("f", 4, "S3,,DE101,PRESENT"),                      # empty date: NULL, accepted
        ("f", 5, "S4,2026-13-45,DE101,PRESENT,x"),          # two faults: two rejects
        ("f", 6, ""),                                       # blank line skipped
    ], "_source_file string, _line long, value string")
    good, rejects = parse_csv_lines(lines, SCHEMA)
    g = {r.student_id: r for r in good.collect()}
    assert set(g) == {"S1", "S2", "S3"}
    assert g["S2"].module_code == "A,B" and g["S3"].class_date is None
    assert sorted((r._line, r.error_type) for r in rejects.collect()) == [(5, "CAST"), (5, "TOO MANY COLUMNS")]


def test_line_numbers_across_files_and_splits(spark):
    d = tempfile.mkdtemp(prefix="csv-split-")
    n = 4000
    for day in range(3):
        m = n if day else n // 2          # one smaller file (< 100 kB), two larger
        _write(d, f"att_{day}.csv", [HEADER] + [f"S{i:05d},2026-09-0{day + 1},M{i % 7},PRESENT" for i in range(m)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        rows = read_lines(spark, os.path.join(d, "*.csv")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 2 * (n + 1) + (n // 2 + 1)
    assert len({(r._source_file, r._line) for r in rows}) == len(rows)
    for r in rows:
        if r._line == 1:
            assert r.value == HEADER
        else:
            assert r.value.startswith(f"S{r._line - 2:05d},")


def odd_files():
    """Names with glob characters and spaces, a byte-order mark, blank lines at the end."""
    d = tempfile.mkdtemp(prefix="csv-odd-")
    for name, text in [("day[1].csv", "h\n1\n"), ("day1.csv", "h\n2\n"), ("o k.csv", "h\n3\n"), ("a{b}*?.csv", "h\n4\n")]:
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    with open(os.path.join(d, "bom.csv"), "wb") as f:
        f.write(b"\xef\xbb\xbfh\r\n5\r\n\r\n\r\n")
    return d


def test_paths_are_read_once_and_as_they_are(spark):
    d = odd_files()
    whole = [(r._line, r.value) for r in read_lines(spark, os.path.join(d, "*.csv")).collect()]
    assert sorted(v for n, v in whole if n == 2) == ["1", "2", "3", "4", "5"]
    assert sorted(v for n, v in whole if n == 1) == ["h"] * 5 and sorted(n for n, v in whole if v == "") == [3, 4]
    assert sorted(whole) == sorted((r._line, r.value) for r in read_lines(spark, d).collect())
    named = read_lines(spark, [literal_path(os.path.join(d, n)) for n in ("day[1].csv", "o k.csv", "a{b}*?.csv")])
    assert sorted(r.value for r in named.where("_line = 2").collect()) == ["1", "3", "4"]
    for missing in (os.path.join(d, "none.csv"), [os.path.join(d, "day1.csv"), os.path.join(d, "none.csv")], os.path.join(d, "*.txt")):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            read_lines(spark, missing)


def test_good_plus_rejects_equals_data_lines(spark):
    d = tempfile.mkdtemp(prefix="csv-m-")
    _write(d, "a.csv", _corrupt_fixture())
    _write(d, "b.csv", [HEADER, "S1,2026-09-07,DE101,PRESENT"], crlf=False)
    good, rejects = read_csv_quarantined(spark, d, SCHEMA)
    assert good.count() + rejects.select("_source_file", "_line").distinct().count() == 81


def test_single_pass_load_outcomes(spark):
    from layerkit.session import scratch_path
    from layerkit.sources import load_csv_quarantined

    d = tempfile.mkdtemp(prefix="csv-one-")
    _write(d, "attendance_corrupt.csv", _corrupt_fixture())
    out = scratch_path(spark, "load")
    good, rejects = load_csv_quarantined(spark, os.path.join(d, "*.csv"), SCHEMA, out)
    assert good.count() == 75 and good.columns[:4] == ["student_id", "class_date", "module_code", "status"]
    assert sorted((r._line, r.error_type) for r in rejects.collect()) == [
        (10, "TOO MANY COLUMNS"), (29, "TOO MANY COLUMNS"), (46, "MISSING COLUMNS"), (63, "CAST"), (75, "CAST")]
    assert os.path.isdir(out.replace("file:", "") + "/outcome=good")


def test_reject_report_is_ordered_by_file_and_line(spark):
    d = tempfile.mkdtemp(prefix="csv-order-")
    for name in ("b.csv", "a.csv", "c.csv"):
        _write(d, name, _corrupt_fixture())
    _, rejects = read_csv_quarantined(spark, d, SCHEMA)
    got = [(r.file_path, r.line, r.error_type) for r in reject_report(rejects.repartition(7)).collect()]
    assert len(got) == 15 and got == sorted(got)


def test_long_quoted_fields(spark):
    text = "x, " * 60_000
    lines = spark.createDataFrame([("f", 1, HEADER), ("f", 2, f'S1,2026-09-07,"{text}""q"",",PRESENT')], "_source_file string, _line long, value string")
    good, rejects = parse_csv_lines(lines, SCHEMA)
    assert rejects.count() == 0 and good.first().module_code == text + '"q",'


def test_small_splits_are_read_several_by_one_task(spark):
    """One task for each split before, each with some KB for the driver."""
    from layerkit.session import least_tasks
    from layerkit.sources.csv_lines import read_lines, read_tasks
    from layerkit.sources.csv_records import read_records

    d = tempfile.mkdtemp(prefix="splits-")
    for f in range(3):
        _write(d, f"f{f}.csv", [f"file {f} line {i}" for i in range(1, 3001)])
    small = spark.newSession()
    small.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    assert small.read.text(d).rdd.getNumPartitions() > 100 > 3 * least_tasks(spark)
    for read in (read_lines, read_records):
        rows = read(small, d)
        assert rows.rdd.getNumPartitions() <= least_tasks(spark)
        assert rows.count() == 9000
        assert rows.where("value != concat('file ', regexp_extract(_source_file, 'f([0-9])\\\\.csv', 1), ' line ', _line)").isEmpty()
    # Splits of Spark's usual size keep a task each.
    assert read_tasks(spark, 10**6) == 10**6 and read_tasks(small, 10**6) == max(least_tasks(spark), 8)
