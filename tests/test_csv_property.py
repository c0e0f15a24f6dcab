"""Property: for well-formed RFC-4180 lines (as written by Python's csv
module), the parser returns exactly the written fields."""

import csv
import io

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from layerkit.sources import parse_csv_lines

SCHEMA = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(4)])
field = st.text(alphabet='ab ,"x', min_size=0, max_size=5)
row = st.tuples(field, field, field, field)


def _line(values):
    buf = io.StringIO()
    csv.writer(buf, lineterminator="").writerow(values)
    return buf.getvalue()


@settings(max_examples=20, deadline=None, derandomize=True)
@given(st.lists(row, min_size=1, max_size=20))
def test_parser_returns_written_fields(spark, rows):
    lines = [("f", i + 2, _line(r)) for i, r in enumerate(rows)]
    df = spark.createDataFrame(lines, "_source_file string, _line long, value string")
    good, rejects = parse_csv_lines(df, SCHEMA, header=False)
    got = {r._line: (r.c0, r.c1, r.c2, r.c3) for r in good.collect()}
    bad = rejects.collect()
    assert not bad, (bad[:2], lines[:3])
    for i, r in enumerate(rows):
        # unquoted empty fields are NULL (like the reference's loader)
        expect = tuple(None if v == "" else v for v in r)
        # a field written quoted but empty ('""') comes back empty or NULL
        assert tuple(None if g == "" else g for g in got[i + 2]) == expect, (lines[i], got[i + 2])
