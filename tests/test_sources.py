"""S1-S14 on small fixtures written to the session's checkpoint folder."""

import pytest
from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sources.csv import panel_periods, read_csv, replace_periods, write_csv
from strata.sources.html import audit, parse_page, table_rows
from strata.sources.panel_files import discover_periods, read_period_sources
from tests.conftest import rows


def test_csv_iso_roundtrip(spark):
    df = spark.createDataFrame([("Pöndorf",), ("Ö",)], "name string")
    p = scratch_path(spark, "csv_iso")
    write_csv(df, p, sep=";", encoding="latin1", single_file=True)
    right = read_csv(spark, p, "name string", sep=";", encoding="latin1")
    assert rows(right) == [("Pöndorf",), ("Ö",)]
    wrong = read_csv(spark, p, "name string", sep=";", encoding="UTF-8")
    assert any("�" in r.name for r in wrong.collect())


def test_multi_file_panel(spark):
    root = scratch_path(spark, "votes")
    a = spark.createDataFrame([("40101", "Linz", 10, 5)], "`Nr.` string, Name string, A int, `B.C` int")
    b = spark.createDataFrame([(40102, "Wels", 7)], "`Nr.` int, Name string, D int")
    write_csv(a, f"{root}/votes_2013", single_file=True)
    write_csv(b, f"{root}/votes_2017", single_file=True)
    with pytest.warns(UserWarning):
        df = read_period_sources(spark, [f"{root}/votes_2013", f"{root}/votes_2017", f"{root}/votes_2024"],
                                 {"Nr.": "string", "Name": "string"}, r"votes_(\d{4})",
                                 default_type="int")
    got = rows(df, "period", "Nr.", "A", "B.C", "D")
    assert got == [(2013, "40101", 10, 5, None), (2017, "40102", None, None, 7)]
    per = discover_periods(spark, root, r"votes_(\d{4})").select("period").distinct().collect()
    assert sorted(r.period for r in per) == [2013, 2017]


PAGES = [
    (1, '<div id="treemap-table-2013"><table><tr><th>h</th></tr>'
        '<tr class="x"><td>1</td><td>Sport &amp; Co</td><td><span class="value-value">12,5</span> EUR</td></tr>'
        '<tr class="sum"><td>2</td><td><b>Summe</b></td><td><span class="value-value">99</span></td></tr>'
        '<tr><td>3</td><td>kurz</td></tr></table></div>'),
    (2, "<html><p>no container</p></html>"),
    (3, '<div id="treemap-table-2014"><p>no table</p></div>'),
]


def test_html_table_rows(spark):
    fn = table_rows
    pages = spark.createDataFrame(PAGES, "page_id long, html string")
    all_rows = rows(fn(pages, ["page_id"]), "page_id", "container", "pos", "row_class", "section", "amount")
    assert all_rows == [(1, "2013", 1, "x", "Sport & Co", "12,5"), (1, "2013", 2, "sum", "Summe", "99")]
    only_sum = rows(fn(pages, ["page_id"], classes=["sum"]), "pos", "section")
    assert only_sum == [(2, "Summe")]


def test_audit(spark):
    pages = spark.createDataFrame(PAGES + [(4, None)], "page_id long, html string")
    got = {r.page_id: r.reason for r in audit(pages, ["page_id"]).collect()}
    assert got == {1: "ok", 2: "container_missing", 3: "table_missing", 4: "no_content"}
    assert F is not None


def test_no_sources_gives_declared_empty_frame(spark):
    root = scratch_path(spark, "none")
    with pytest.warns(UserWarning):
        df = read_period_sources(spark, [f"{root}/a", f"{root}/b"], {}, ddl_if_empty="period INT, x STRING")
    assert df.count() == 0 and df.columns == ["period", "x"]
    with pytest.raises(FileNotFoundError), pytest.warns(UserWarning):
        read_period_sources(spark, [f"{root}/a"], {})


def test_short_rows_with_low_min_cells(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, html string")
    got = rows(table_rows(pages, ["page_id"], min_cells=1), "pos", "section", "amount")
    assert (3, "kurz", None) in got or (3, "kurz", "") in got


def test_period_is_the_last_match(spark):
    from strata.sources.panel_files import period_from_path
    df = spark.createDataFrame([("/tmp/run-5153ab/votes/2013/v.csv",), ("/x/none.csv",)], "p string")
    assert [r[0] for r in df.select(period_from_path("p")).collect()] == [2013, None]


def test_irregular_markup(spark):
    html = ('<DIV class=box ID="treemap-table-2019"><div class="inner"><!-- <tr><td>x</td></tr> -->'
            '<script>if (a < b) { document.write("<tr>") }</script>'
            '<TABLE><TR><TH>h</TH></TR><TR CLASS="sum total"><td>1</td><td>Sport &amp; Spiel</td>'
            '<td><span data-x="1" class=\'value-value big\'>12,5</span></td></TR></TABLE></div></DIV>')
    pages = spark.createDataFrame([(7, html)], "page_id long, html string")
    got = rows(table_rows(pages, ["page_id"]), "container", "pos", "row_class", "section", "amount")
    assert got == [("2019", 1, "sum total", "Sport & Spiel", "12,5")]


def test_container_of_the_period_and_open_cells():
    other = "<div id=p-1><table><tr><td>no</table></div>"
    html = other + "<div class=a id='p-2'><div><div></div><p><table><tr><th>h<tr class=x><td>1<td>&Ouml; &amp;lt;<td><span class='v value-value'>7<tr><td>2<table><tr><td>in</table>"
    assert parse_page(html, "p-2", "p-")["rows"][1]["cells"] == [{"text": "1", "amount": ""}, {"text": "Ö &lt;", "amount": ""}, {"text": "7", "amount": "7"}]
    assert parse_page(html, "p-2", "p-")["rows"][2]["cells"][0]["text"] == "2in"
    assert parse_page(html, None, "p-")["container"] == "p-1"
    assert [parse_page(h, "p-2", "p-")["reason"] for h in (None, " ", other, "<div id=p-2></div>" + other, "<div id=p-2><table><tr></table></div>")] == \
        ["no_content", "no_content", "container_missing", "table_missing", "no_rows"]


def test_files_of_one_folder_with_other_headers(spark):
    root = scratch_path(spark, "mixed headers")
    a = spark.createDataFrame([("1", 10, 20)], "Nr string, A int, B int")
    write_csv(a, f"{root}/v_2013", encoding="latin1")
    write_csv(a.select("Nr", "B", "A"), f"{root}/v_2014", encoding="latin1")
    write_csv(a.select("Nr", F.col("A").alias("Ö"), "B"), f"{root}/v_2015", encoding="latin1")
    df = read_period_sources(spark, [root], {"Nr": "string"}, r"v_(\d{4})", default_type="int", encoding="latin1")
    assert rows(df, "period", "A", "B", "Ö") == [(2013, 10, 20, None), (2014, 10, 20, None), (2015, None, 20, 10)]


def test_headers_are_read_by_one_task_a_file_whatever_its_size(spark):
    from strata.sources.panel_files import files_by_header
    root = scratch_path(spark, "headers [x] %41")
    big = spark.range(300_000).selectExpr("id AS a", "id * 7 AS b")
    write_csv(big.coalesce(1), f"{root}/2013")
    write_csv(big.limit(3).coalesce(1), f"{root}/2014")
    write_csv(big.limit(3).select("b", "a").coalesce(1), f"{root}/2015")
    spark.createDataFrame([], "value string").coalesce(1).write.text(f"{root}/2016")
    tracker, key = spark.sparkContext.statusTracker(), "spark.sql.files.maxPartitionBytes"
    spark.conf.set(key, "262144")
    try:
        assert spark.read.csv(root.replace("[", "\\[").replace("]", "\\]") + "/2013").rdd.getNumPartitions() > 8
        known = set(tracker.getJobIdsForGroup(None))
        groups = files_by_header(spark, root.replace("[", "\\[").replace("]", "\\]"))
        jobs = [tracker.getJobInfo(j) for j in set(tracker.getJobIdsForGroup(None)) - known]
        tasks = [tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds]
    finally:
        spark.conf.unset(key)
    assert sorted(len(g) for g in groups) == [1, 2]
    assert tasks and max(tasks) <= 4              # the listing has one task a file at most, each header one


def test_periods_are_replaced_and_no_others(spark):
    path = scratch_path(spark, "rerun")
    df = spark.createDataFrame([(i % 3 or None, i, f"x{i}") for i in range(90)], "`the year` int, v int, s string").repartition(3)
    replace_periods(df, path, "the year", rows_per_file=8)
    replace_periods(df, path, "the year", rows_per_file=8)                   # a plain rerun changes nothing
    assert rows(spark.read.parquet(path), "the year", "v", "s") == rows(df)
    replace_periods(df.where("`the year` = 2").limit(4), path, "the year")
    replace_periods(df.where("false"), path, "the year")
    got = spark.read.parquet(path)
    assert rows(got.where("`the year` = 1"), "v") == rows(df.where("`the year` = 1"), "v") and got.where("`the year` is null").count() == 30
    assert got.where("`the year` = 2").count() == 4
    assert rows(panel_periods(spark, path)) == sorted([(None, 30), (1, 30), (2, 4)], key=repr)
    files = [f for f in got.inputFiles() if "year=1" in f.replace("%20", " ")]
    assert 1 < len(files) <= 4                                                # 30 rows in files of about 8
