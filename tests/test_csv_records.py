"""Records with quoted line breaks, over splits of any size."""

import csv
import hashlib
import os
import random
import tempfile

import pytest
from pyspark.sql import types as T

from layerkit.sources import load_csv_quarantined, read_csv_quarantined, read_records, reject_report
from layerkit.sources.csv_records import ends_inside
from layerkit.session import scratch_path

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("who", T.StringType()), T.StructField("said", T.StringType())])


def write(name, text, folder=None):
    folder = folder or tempfile.mkdtemp(prefix="records-")
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
        f.write(text)
    return folder


def as_csv(rows, end="\r\n"):
    out = []
    for r in rows:
        out.append(",".join(f'"{c.replace(chr(34), chr(34) * 2)}"' if any(x in c for x in ',"\r\n') else c for c in r))
    return end.join(out) + end


@pytest.fixture
def splits(spark):
    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_states_by_line():
    assert [ends_inside(x, False) for x in ("a,b", 'a,"b', 'a,"b"', 'a,"b""', '5" pipe,x', '"a","b', '"a"x,"b""c",d', '"', '""', '"""', 'a,"b"c","d')] == \
        [False, True, False, True, False, True, False, True, False, True, True]
    assert [ends_inside(x, True) for x in ("a,b", 'a",b', 'a"', 'a""', 'a","b', '",5" pipe', '"', '""', '"","x"')] == \
        [True, False, False, True, True, False, False, True, False]


@pytest.mark.parametrize("size", [250, 5000])
def test_like_pythons_reader(spark, splits, size):
    rng = random.Random(size)
    said = ["x", "a,b", "two\nlines", "\n\n", 'q"uo"te', '""', "", "é\n漢", '",\n"', "one\r\ntwo", '5" pipe']
    folder = tempfile.mkdtemp(prefix="records-")
    want = {}
    for k in range(4):
        rows = [(str(i), rng.choice(["ann", "b c", "d,e"]), "".join(rng.choice(said) for _ in range(rng.randint(0, 6)))) for i in range(150)]
        if k == 2:
            rows[70] = ("70", "long", "line\n" * 1500)  # over many splits
        text = as_csv([("id", "who", "said"), *rows], "\n" if k % 2 else "\r\n")
        write(f"f{k}.csv", text, folder)
        line = 1
        for r in [("id", "who", "said"), *rows]:
            want[f"f{k}.csv", line] = r
            line += as_csv([r], "\n").count("\n")
        with open(os.path.join(folder, f"f{k}.csv"), newline="", encoding="utf-8") as f:
            assert [tuple(r) for r in csv.reader(f)][1:] == rows
    splits(size)
    good, rejects = read_csv_quarantined(spark, folder, SCHEMA, quoted_breaks=True)
    got = {(os.path.basename(r._source_file), r._line): (str(r.id), r.who, r.said or "") for r in good.collect()}
    assert rejects.count() == 0
    assert got == {k: v for k, v in want.items() if k[1] != 1}


def test_broken_quotes_are_one_reject(spark, splits):
    lines = ["id,who,said"] + [f'{i},"p","a\nb{i}"' for i in range(50)]
    broken = "\n".join([*lines, '99,"p","never closed', *(f'{i},"x",y' for i in range(200))]) + "\n"
    folder = write("broken.csv", broken)
    write("fine.csv", "\n".join(lines) + "\n", folder)
    for size in (400, 100_000):
        splits(size)
        out = scratch_path(spark, "records")
        good, rejects = load_csv_quarantined(spark, folder, SCHEMA, out, quoted_breaks=True)
        # From the open field on quotes change sides: what is closed by chance is a record.
        rep = [(os.path.basename(r.file_path), r.line, r.error_type, r.csv_line) for r in reject_report(rejects).collect()]
        assert good.where("_source_file like '%fine.csv'").count() == 50
        assert good.where("_source_file like '%broken.csv'").count() >= 50 and good.where("said = 'a\nb49'").count() == 2
        assert all(n >= 102 for _, n, _, _ in rep) and {f for f, *_ in rep} <= {"broken.csv"}
    folder = write("open.csv", "\n".join([*lines, '99,"p","never closed', *("no quote here" for _ in range(2000))]) + "\n")
    for size in (1000, 1_000_000):
        splits(size)
        good, rejects = read_csv_quarantined(spark, folder, SCHEMA, quoted_breaks=True)
        assert good.count() == 50
        assert [(r.line, r.error_type, r.column_name, r.csv_line) for r in reject_report(rejects).collect()] == [(102, "UNQUOTED VALUE", None, '99,"p","never closed')]


def test_stray_quotes_and_faults(spark, splits):
    text = 'id,who,said\n1,5" pipe,x\n2,p,"a\n,b"\n3,"p"\nx,"p","c\nd"\n4,p,"e\nf",extra\n\n5,p,\n'
    for size in (8, 1000):
        splits(size)
        good, rejects = read_csv_quarantined(spark, write("a.csv", text), SCHEMA, quoted_breaks=True)
        assert sorted((r.id, r._line, r.who, r.said) for r in good.collect()) == [(1, 2, '5" pipe', "x"), (2, 3, "p", "a\n,b"), (5, 11, "p", None)]
        assert [(r.line, r.error_type, r.column_name) for r in reject_report(rejects).collect()] == [
            (5, "MISSING COLUMNS", "said"), (6, "CAST", "id"), (8, "TOO MANY COLUMNS", None)]


def test_odd_files(spark, splits):
    folder = write("bom.csv", "﻿id,who,said\r\n1,a,\"x\r\ny\"\r\n")
    write("empty.csv", "", folder)
    write("header.csv", "id,who,said", folder)
    write("last.csv", 'id,who,said\n7,b,"no line\nend"', folder)
    splits(16)
    rows = sorted((os.path.basename(r._source_file), r._line, r.value, r._open) for r in read_records(spark, folder).collect())
    assert rows == [("bom.csv", 1, "id,who,said", False), ("bom.csv", 2, '1,a,"x\r\ny"', False), ("header.csv", 1, "id,who,said", False),
                    ("last.csv", 1, "id,who,said", False), ("last.csv", 2, '7,b,"no line\nend"', False)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_records(spark, folder + "/none.csv")
