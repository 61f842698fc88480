"""Landed text exports with lines that do not fit, and typed payloads."""

import tempfile

from equiframe.sources.landed import QUARANTINE, land_export, quarantine_counts, read_export
from equiframe.sources.payload import explode_variant
from equiframe.sources.tables import TableStore

COLS = ["sym_cd", "fs_q", "sales", "memo"]
GOOD = ['A005930,2020 Q1,"1,234",plain', 'A000660,2020 Q1,,"say ""hi"", twice"', "A1,2020 Q2,-,"]
BAD = ["A1,2020 Q1", "A1,2020 Q1,1,x,y", ",2020 Q1,1,x", "A1,   ,1,x"]


def land(name_lines):
    root = tempfile.mkdtemp(prefix="equiframe-export-", dir="/tmp")
    for name, lines in name_lines.items():
        with open(f"{root}/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")
    return root


def test_lines_that_do_not_fit_are_kept_apart(spark):
    head = ",".join(COLS)
    root = land({"a.csv": [head, *GOOD, "", *BAD], "b.csv": [head, GOOD[0], BAD[0]], "empty.csv": [head]})
    export = read_export(spark, root, COLS, ["sym_cd", "fs_q"])
    rows = [tuple(r) for r in export.rows.collect()]
    assert sorted(rows, key=str) == sorted([
        ("A005930", "2020 Q1", "1,234", "plain"), ("A000660", "2020 Q1", None, 'say "hi", twice'), ("A1", "2020 Q2", "-", None),
        ("A005930", "2020 Q1", "1,234", "plain")], key=str)
    assert export.quarantine.columns == QUARANTINE
    assert sorted(map(tuple, export.quarantine.collect())) == sorted(
        [("a.csv", BAD[0], "fields"), ("a.csv", BAD[1], "fields"), ("a.csv", BAD[2], "key"), ("a.csv", BAD[3], "key"),
         ("b.csv", BAD[0], "fields")])
    counts = {(r.file, r.reason): r.lines for r in quarantine_counts(export.quarantine).collect()}
    assert counts == {("a.csv", "fields"): 2, ("a.csv", "key"): 2, ("b.csv", "fields"): 1}
    # one column alone tells misfits like all of them
    assert export.rows.select("sym_cd").count() == 4


def test_landing_again_adds_no_line_twice(spark):
    root = land({"a.csv": [*GOOD, *BAD]})
    store = TableStore(spark, tempfile.mkdtemp(prefix="equiframe-store-", dir="/tmp"))
    for _ in range(2):
        assert land_export(spark, root, COLS, ["sym_cd", "fs_q"], store.path("quarantine"), header=False).count() == len(GOOD)
        assert sorted(r.line for r in store.scan("quarantine").collect()) == sorted(BAD)


def test_an_export_without_lines(spark):
    export = read_export(spark, land({"a.csv": [",".join(COLS)]}), COLS, ["sym_cd"])
    assert export.rows.collect() == [] and export.quarantine.collect() == []


def test_typed_payloads(spark):
    docs = [(1, '{"z": [{"a": 1, "b": {"c": "2020-01-02"}, "l": [5, 6]}, {"a": "7"}, {}, 3], "a": [{"a": 99}]}'),
            (2, '{"z": {"a": 1}}'), (3, "{}"), (4, "not json"), (5, None), (6, '{"z": []}'), (7, '[{"a": 1}]'), (8, '{"z": [{"a": "no"}]}')]
    df = spark.createDataFrame(docs, "id int, payload string")
    got = explode_variant(df, {"a": ("$.a", "int"), "day": ("$.b.c", "date"), "l": ("$.l[1]", "bigint")}, keep=["id"]).collect()
    rows = sorted(((r.id, r.a, r.day and r.day.isoformat(), r.l) for r in got), key=str)
    assert rows == sorted([(1, 1, "2020-01-02", 6), (1, 7, None, None), (1, None, None, None), (1, None, None, None),
                           (8, None, None, None)], key=str)
