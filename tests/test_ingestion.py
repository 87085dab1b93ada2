"""F1 ingest contract: header spellings, float digitals, missing/duplicate columns, row-numbered errors."""
import pytest
from pyspark.sql import functions as F

from hourwise.sources import csv_ingest as I

HEADER = ",timestamp,TP2,TP3,H1,DV_pressure,Reservoirs,Oil_temperature,Motor_current,COMP,DV_eletric,Towers,MPG,LPS,Pressure_switch,Oil_level,Caudal_impulses"


def row(i, ts="2020-02-01 00:00:00", analog="7.1", digital="0.0", impulse="1.0"):
    return ",".join([str(i), ts] + [analog] * 7 + [digital] * 7 + [impulse])


def write(tmp_path, lines, name="data.csv", bom=False):
    p = tmp_path / name
    text = "\n".join(lines) + "\n"
    p.write_text(("﻿" if bom else "") + text, encoding="utf-8")
    return str(p)


def test_good_row_and_bom(spark, tmp_path):
    res = I.scan_csv(spark, write(tmp_path, [HEADER, row(0)], bom=True))
    r = res.valid.first()
    assert res.quarantine.count() == 0 and r.source_row == 1 and r.caudal_impulse == 1.0 and r.oil_level == 0


def test_missing_and_duplicate_columns(spark, tmp_path):
    with pytest.raises(I.IngestError, match="missing required columns"):
        I.scan_csv(spark, write(tmp_path, [HEADER.rsplit(",", 1)[0], row(0)], "a.csv"))
    with pytest.raises(I.IngestError, match="Duplicate CSV column"):
        I.scan_csv(spark, write(tmp_path, [HEADER + ",TP2", row(0) + ",1"], "b.csv"))


def test_empty_file(spark, tmp_path):
    p = tmp_path / "empty.csv"
    p.write_text("")
    with pytest.raises(I.IngestError, match="empty"):
        I.scan_csv(spark, str(p))


def test_row_numbers_of_defects(spark, tmp_path):
    lines = [HEADER] + [row(i) for i in range(60)]
    lines[52] = row(51, digital="2.0")        # data row 52: bad digital
    lines[53] = row(52, analog="inf")         # data row 53: non-finite
    lines[10] = row(9, ts="2020-02-01 00:00:00+05:30")
    lines[11] = row(10, analog="1d")
    lines[12] = row(11, analog="NaN")
    lines[13] = "12,2020-02-01 00:00:00,1.0"  # short row
    lines[14] = ""                            # blank line mid-file
    res = I.scan_csv(spark, write(tmp_path, lines))
    q = {r.source_row: r.violations for r in res.quarantine.collect()}
    assert q[52] == ["not_0_1:comp", "not_0_1:dv_electric", "not_0_1:towers", "not_0_1:mpg", "not_0_1:lps",
                     "not_0_1:pressure_switch", "not_0_1:oil_level"]
    assert q[53][0] == "non_finite:tp2"
    assert q[10] == ["timezone"] and q[11][0] == "unparseable:tp2" and q[12][0] == "non_finite:tp2"
    assert q[13] == ["short_row"] and q[14] == ["blank_row"]
    assert res.valid.count() == 60 - 7
    with pytest.raises(I.IngestError, match="row 10"):
        I.fail_fast(res)


def test_multi_split_file_keeps_file_order(spark, tmp_path):
    lines = [HEADER] + [row(i, ts=f"2020-02-01 00:{i // 60:02d}:{i % 60:02d}") for i in range(3000)]
    path = write(tmp_path, lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        res = I.scan_csv(spark, path)
        got = sorted((r.source_row, r.observed_at.minute * 60 + r.observed_at.second) for r in res.valid.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [(i + 1, i) for i in range(3000)]


def test_completeness_gate(spark, tmp_path):
    res = I.scan_csv(spark, write(tmp_path, [HEADER, row(0), row(1)]))
    assert I.completeness_gate(res.valid, 2).first().passes
    assert not I.completeness_gate(res.valid, 3).first().passes
    assert I.completeness_gate(res.valid, 3, allow_subset=True).first().passes
    with pytest.raises(I.IngestError):
        I.assert_complete(I.completeness_gate(res.valid.limit(0), 3, allow_subset=True))


def test_quotes_column_orders_and_empty_rows(spark, tmp_path):
    folder = tmp_path / "a folder, with spaces"
    folder.mkdir()
    names = HEADER.split(",")
    quoted = [f'"{c}"' for c in row(1, analog="7.25").split(",")]
    write(folder, [HEADER, row(0), ",".join(quoted), "," * 16, "  "], "1.csv")
    back = dict(zip(names, row(2, analog="3.5").split(",")))
    back["TP2"], back["TP3"] = "1.0", "2.0"
    order = sorted(names, reverse=True)
    write(folder, [",".join(order), ",".join(back[n] for n in order), '"x' + row(3)], "2.csv", bom=True)
    res = I.scan_csv(spark, str(folder))
    got = {r.source_row: (r.tp2, r.tp3) for r in res.valid.collect()}
    assert got == {1: (7.1, 7.1), 2: (7.25, 7.25), 5: (1.0, 2.0)}
    assert {r.source_row: r.violations for r in res.quarantine.collect()} == {3: ["blank_row"], 4: ["blank_row"], 6: ["open_quote"]}


def test_cells_with_commas_and_doubled_quotes(spark):
    lines = ['a,"b,c",d', '"say ""hi""",x', "plain,,", '""']
    got = spark.createDataFrame([(x,) for x in lines], "v string").select(I.fields_of(F.col("v")).alias("c")).collect()
    assert [r.c for r in got] == [["a", "b,c", "d"], ['say "hi"', "x"], ["plain", "", ""], [""]]


def test_later_file_without_a_column_is_fatal(spark, tmp_path):
    write(tmp_path, [HEADER, row(0)], "1.csv")
    write(tmp_path, [HEADER.replace(",TP2", ",other"), row(1)], "2.csv")
    with pytest.raises(I.IngestError, match="tp2"):
        I.scan_csv(spark, str(tmp_path))


def test_text_is_not_shuffled(spark, tmp_path):
    path = write(tmp_path, [HEADER] + [row(i) for i in range(500)])
    res = I.scan_csv(spark, path)
    for df in (res.valid, res.quarantine):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_generated_source_has_more_files_for_more_rows(spark):
    from pathlib import Path

    from conftest import SF
    from hourwise.plans import catalog_sources as C
    few, many = (C.write_dirty_csv(spark, SF, n) for n in (C.FILE_ROWS, 50))
    count = lambda path: len(list(Path(path.removeprefix("file:")).glob("file=*/part-*")))
    rows = C.readings(spark, SF).count()
    assert count(few) == C.DIRTY_FILES and count(many) == -(-rows // 50) > 10

    def numbers(path):
        res = I.scan_csv(spark, path)
        return (sorted(tuple(r) for r in res.valid.select("source_row", "observed_at").collect()),
                sorted((r.source_row, tuple(r.violations)) for r in res.quarantine.collect()))
    assert numbers(few) == numbers(many)


def test_line_breaks_inside_quoted_cells(spark, tmp_path):
    """Records over several lines, over split edges and beside plain files; an open quote is one bad record."""
    names = HEADER.split(",")
    folder = tmp_path / "csv"
    folder.mkdir()
    rows, at = [HEADER], 0
    for i in range(400):
        if i % 7 == 3:
            rows.append(row(f'"{i}\nline two\n\nline four"', ts=f"2020-02-01 00:{i // 60:02d}:{i % 60:02d}"))
        elif i % 50 == 9:
            rows.append(row(f'"a ""quoted"" {i}\n"', analog="x"))
        else:
            rows.append(row(i, ts=f"2020-02-01 00:{i // 60:02d}:{i % 60:02d}"))
    write(folder, rows, "1.csv")
    write(folder, [HEADER, row(1), row(2, digital="2.0")], "2.csv")
    write(folder, ['"' + names[0] + '\nnew","' + '","'.join(names[1:]) + '"', row('"x\ny"'), row(5), '"open', row(6), row(7)], "3.csv")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("4k", old):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            res = I.scan_csv(spark, str(folder))
            got = {r.source_row: r.observed_at for r in res.valid.collect()}
            bad = {r.source_row: (r.line, r.violations[0]) for r in res.quarantine.collect()}
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        wrong = {i for i in range(400) if i % 7 != 3 and i % 50 == 9}
        assert sorted(got) == [*(i + 1 for i in range(400) if i not in wrong), 401, 403, 404]
        assert all(got[i + 1].minute * 60 + got[i + 1].second == i for i in range(400) if i not in wrong)
        assert set(bad) == {i + 1 for i in wrong} | {402, 405}
        assert bad[402][1] == "not_0_1:comp" and bad[405] == ('"open', "open_quote")
        assert all(bad[i + 1] == (row(f'"a ""quoted"" {i}\n"', analog="x"), "unparseable:tp2") for i in wrong)


def test_records_over_the_line_limit_count_as_open(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "MAX_RECORD_LINES", 5)
    path = write(tmp_path, [HEADER, row('"' + "a\n" * 4 + 'b"'), row('"' + "a\n" * 5 + 'b"'), row(3)])
    res = I.scan_csv(spark, path)
    assert sorted(r.source_row for r in res.valid.collect()) == [1, 3]
    assert [(r.source_row, r.line, r.violations) for r in res.quarantine.collect()] == [(2, '"a', ["open_quote"])]


def test_any_number_of_different_headers_and_session_options(spark, tmp_path):
    names = HEADER.split(",")
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(1100):
        write(folder, [",".join([f"extra{i}", *names[1:]]), row(i)], f"{i:05d}.csv")
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    res = I.scan_csv(spark, str(folder))
    assert res.valid.count() == 1100 and res.quarantine.count() == 0
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) == before
    assert res.headers == ["extra0", *names[1:]]


def test_numbers_too_large_are_not_finite(spark, tmp_path):
    res = I.scan_csv(spark, write(tmp_path, [HEADER, row(0, analog="1e999"), row(1, impulse="-1"), row(2, analog=" 1.5 ")]))
    got = {r.source_row: r.violations[0] for r in res.quarantine.collect()}
    assert got == {1: "non_finite:tp2", 2: "invalid_impulse:caudal_impulse"} and res.valid.first().tp2 == 1.5


def test_a_load_types_its_rows_once(spark, tmp_path, monkeypatch):
    """Valid rows and quarantine read the written table: no text scan is left in their plans."""
    res = I.scan_csv(spark, write(tmp_path, [HEADER, row(0), "x"]))
    for df in (res.valid, res.quarantine):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "csv_rows" in df.inputFiles()[0] and "rlike" not in plan.lower()
