import io

import pytest
import os
import tarfile
import zipfile

from pyspark.sql import functions as F

from terrace.plans.landing import land
from terrace.functions.text import fill_template
from terrace.plans.reports import output_folder, run_reports
from terrace.quality.files import check_csv_columns, check_csv_format, check_filenames, flag_unchanged
from terrace.sources.files import expand_archives, list_files, read_nested_json
from terrace.specs import CsvSpec, JsonSpec, LandingSpec, ReportSpec, TableSpec
from terrace.sinks.tables import read_target


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_format_long_rows_invalid_short_rows_valid(spark, tmp_dir):
    write(f"{tmp_dir}/in/good.csv", 'a,b,c\n1,2,3\n1,2\n\n"x,y",2,3\n')
    write(f"{tmp_dir}/in/bad.csv", "a,b\n1,2,3\n")
    got = {r.file_name: (r.result, r.rows) for r in check_csv_format(spark, f"{tmp_dir}/in").collect()}
    assert got == {"good.csv": (True, 3), "bad.csv": (False, 1)}


def test_csv_columns_normalised_in_order(spark, tmp_dir):
    write(f"{tmp_dir}/in/a.csv", "Account Number,Total / Return\n1,2\n")
    write(f"{tmp_dir}/in/b.csv", "total_return,account_number,extra\n1,2,3\n")
    exp = ["account_number", "total_return"]
    got = {r.file_name: r for r in check_csv_columns(spark, f"{tmp_dir}/in", exp).collect()}
    assert got["a.csv"].result is True
    assert got["b.csv"].result is False and got["b.csv"].extra_columns == ["extra"] and got["b.csv"].missing_columns == []


def test_filename_pattern_anchored_at_start(spark):
    df = spark.createDataFrame([("2024_x.csv",), ("a_2024_x.csv",)], "file_name string")
    assert [r.result for r in check_filenames(df, r"\d{4}_").collect()] == [True, False]


def test_tar_members_skip_directories(spark, tmp_dir):
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w") as t:
        d = tarfile.TarInfo("sub"); d.type = tarfile.DIRTYPE; t.addfile(d)
        data = b"hello"
        f = tarfile.TarInfo("sub/a.txt"); f.size = len(data); t.addfile(f, io.BytesIO(data))
    with open(f"{tmp_dir}/x.tar", "wb") as fh:
        fh.write(buf.getvalue())
    files = list_files(spark, tmp_dir, "*.tar", with_content=True)
    out = expand_archives(files, "tar").collect()
    assert [(r.member, bytes(r.content)) for r in out] == [("sub/a.txt", b"hello")]


def test_zip_members_with_archive_row(spark, tmp_dir):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("m1.csv", "a\n1\n")
        z.writestr("dir/", "")
    with open(f"{tmp_dir}/x.zip", "wb") as fh:
        fh.write(buf.getvalue())
    out = expand_archives(list_files(spark, tmp_dir, "*.zip", with_content=True), "zip", include_archive=True).collect()
    assert sorted((r.member, r.validate) for r in out) == [("m1.csv", True), ("x.zip", False)]


def test_flag_unchanged_uses_latest_copy(spark):
    incoming = spark.createDataFrame([("a.csv", "v2"), ("b.csv", "same"), ("new.csv", "n")], "file_name string, content string")
    processed = spark.createDataFrame([
        ("p/insert_date=2024-01-01/insert_time=10:00:00/a.csv", "a.csv", "v2"),
        ("p/insert_date=2024-01-02/insert_time=09:00:00/a.csv", "a.csv", "v1"),
        ("p/insert_date=2024-01-01/insert_time=10:00:00/b.csv", "b.csv", "same"),
        ("p/insert_date=2024-01-03/insert_time=10:00:00/x_b.csv", "x_b.csv", "other")], "path string, file_name string, content string")
    got = {r.file_name: r.is_duplicate for r in flag_unchanged(incoming, processed).collect()}
    assert got == {"a.csv": False, "b.csv": True, "new.csv": False}


def test_nested_json_missing_level_raises_or_drops(spark):
    lines = spark.createDataFrame([('{"data": {"rows": [{"a": 1}]}}',), ('{"other": 1}',)], "value string")
    spec = JsonSpec("data.rows")
    assert read_nested_json(spark, lines, spec, columns=["a"], file_date="2024-01-01", drop_missing=True).count() == 1
    try:
        read_nested_json(spark, lines, spec, columns=["a"], file_date="2024-01-01").collect()
    except Exception as e:
        assert "not found" in str(e)
    else:
        raise AssertionError("expected a missing-path error")


def test_nested_json_dynamic_types(spark):
    lines = spark.createDataFrame([('{"r": [{"a": 1, "b": 2.5, "c": "x"}]}',)], "value string")
    df = read_nested_json(spark, lines, JsonSpec("r"), file_date="2024-01-01", dynamic=True)
    types = dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    assert types["b"] == "double" and types["a"] == "bigint" and types["c"] == "string"


def test_landing_statuses(spark, tmp_dir):
    write(f"{tmp_dir}/land/data_2024_01_05.csv", "id,name\n1,a\n2,b\n")
    write(f"{tmp_dir}/land/data_2024_01_06.csv", "id,name\n3,c,extra\n")
    write(f"{tmp_dir}/land/other.txt", "x\n")
    spec = LandingSpec(filename_pattern=r"data_\d{4}_\d{2}_\d{2}\.csv", date_regex=r"(\d{4})_(\d{2})_(\d{2})")
    raw = TableSpec(f"{tmp_dir}/raw", partition_field="data_date")
    res = land(spark, f"{tmp_dir}/land", spec, raw, columns=["id", "name"])
    st = {r.file_name: r.status for r in res.status.collect()}
    assert st == {"data_2024_01_05.csv": "PROCESSED", "data_2024_01_06.csv": "ERROR", "other.txt": "SKIP_PATTERN"}
    assert sorted(tuple(r) for r in read_target(spark, res.table).collect()) == [("1", "a", "2024-01-05"), ("2", "b", "2024-01-05")]


def test_reports_status_and_template(spark, tmp_dir):
    spark.range(3).selectExpr("id", "CAST(id AS STRING) AS name").createOrReplaceTempView("rep_src")
    ok = ReportSpec(name="My Report!", source="rep_src", columns=["id", "name"], where="name <> '{file_name}'",
                    filename_pattern="r_{file_date}.csv", csv=CsvSpec())
    empty = ReportSpec(name="Empty", source="rep_src", columns=["id"], where="id > 99", csv=CsvSpec())
    st = {r.name: r for r in run_reports(spark, [ok, empty], {"file_date": "2024-01-01", "file_name": "1"}, tmp_dir).collect()}
    assert st["My Report!"].success and st["My Report!"].path.endswith("my_report/inbound/r_2024-01-01.csv")
    assert not st["Empty"].success and "no data" in st["Empty"].error
    assert spark.read.option("header", "true").csv(st["My Report!"].path).count() == 2
    lit = fill_template("'{v}'", {"v": "o'k\\"}, quote=True)
    assert spark.sql(f"SELECT {lit} AS v").first().v == "o'k\\"


def test_csv_profile_header_position_one(spark, tmp_dir):
    write(f"{tmp_dir}/in/p.csv", "# delivered by x\na,b\n1,2\n1,2,3\n")
    spec = CsvSpec(header_position=1)
    got = {r.file_name: (r.result, r.rows) for r in check_csv_format(spark, f"{tmp_dir}/in", spec).collect()}
    assert got == {"p.csv": (False, 2)}
    cols = check_csv_columns(spark, f"{tmp_dir}/in", ["a", "b"], spec).first()
    assert cols.result is True


def test_landing_json_documents(spark, tmp_dir):
    write(f"{tmp_dir}/land/api_2024-03-01.json",
          '{"response_content": [{"assetId": "A1", "price": 10.5}, {"assetId": "A2", "price": 3}]}\n'
          '{"response_content": [{"assetId": "A3"}], "data_date": "2024-03-02"}\n')
    spec = LandingSpec(filename_pattern=r"api_\d{4}-\d{2}-\d{2}\.json", file_format="json",
                       json=JsonSpec("response_content"))
    raw = TableSpec(f"{tmp_dir}/raw", partition_field="data_date")
    res = land(spark, f"{tmp_dir}/land", spec, raw, columns=["assetId", "price"])
    assert [r.status for r in res.status.collect()] == ["PROCESSED"]
    got = sorted(tuple(r) for r in read_target(spark, res.table).fillna("-").collect())
    assert got == [("A1", "10.5", "2024-03-01"), ("A2", "3", "2024-03-01"), ("A3", "-", "2024-03-02")]


def _zip(path, members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(buf.getvalue())


def test_landing_zip_members(spark, tmp_dir):
    _zip(f"{tmp_dir}/land/RIPS_20240105_PROD.ZIP", {"RIPS_1.TXT": "id,v\n1,a\n2,b\n", "RIPS_2.TXT": "id,v\n3,c\n"})
    _zip(f"{tmp_dir}/land/RIPS_20240106_PROD.ZIP", {"RIPS_3.TXT": "id,v\n4,d\n", "notes.md": "id,v\n5,e\n"})
    _zip(f"{tmp_dir}/land/RIPS_20240107_PROD.ZIP", {"RIPS_4.TXT": "id,v\n6,f,extra\n"})
    spec = LandingSpec(filename_pattern=r"RIPS_\d{8}_PROD\.ZIP", zipped="zip", member_pattern=r"RIPS_.*\.TXT",
                       date_regex=r"(\d{4})(\d{2})(\d{2})")
    raw = TableSpec(f"{tmp_dir}/raw", partition_field="data_date")
    res = land(spark, f"{tmp_dir}/land", spec, raw, columns=["id", "v"])
    raw = res.table
    st = {r.file_name: (r.status, r.error) for r in res.status.collect()}
    assert st["RIPS_20240105_PROD.ZIP"] == ("PROCESSED", "")
    assert st["RIPS_20240106_PROD.ZIP"] == ("ERROR", "invalid member names: notes.md")
    assert st["RIPS_20240107_PROD.ZIP"] == ("ERROR", "invalid CSV format in a member")
    assert sorted(tuple(r) for r in read_target(spark, raw).collect()) == [
        ("1", "a", "2024-01-05"), ("2", "b", "2024-01-05"), ("3", "c", "2024-01-05")]


def test_landing_partition_from_column_and_xml(spark, tmp_dir):
    write(f"{tmp_dir}/land/rows.xml", '<rows><row id="1"><d>2024-02-01</d><v>x</v></row>'
                                       '<row id="2"><d>bad</d></row></rows>')
    spec = LandingSpec(filename_pattern=r"rows\.xml", file_format="xml", date_column="d")
    raw = TableSpec(f"{tmp_dir}/raw", partition_field="data_date")
    res = land(spark, f"{tmp_dir}/land", spec, raw, columns=["id", "d", "v"])
    assert [r.status for r in res.status.collect()] == ["PROCESSED"]
    got = sorted(tuple(r) for r in read_target(spark, res.table).fillna("-").collect())
    assert got == [("1", "2024-02-01", "x", "2024-02-01"), ("2", "bad", "", "-")]


def test_landing_skips_unchanged_copy(spark, tmp_dir):
    write(f"{tmp_dir}/land/data_2024_01_05.csv", "id,name\n1,a\n")
    processed = spark.createDataFrame(
        [("p/insert_date=2024-01-05/insert_time=10:00:00/data_2024_01_05.csv", "data_2024_01_05.csv", bytearray(b"id,name\n1,a\n"))],
        "path string, file_name string, content binary")
    spec = LandingSpec(filename_pattern=r"data_.*\.csv", date_regex=r"(\d{4})_(\d{2})_(\d{2})",
                       compare_with_previous_file=True)
    res = land(spark, f"{tmp_dir}/land", spec, TableSpec(f"{tmp_dir}/raw"), columns=["id", "name"], processed=processed)
    assert [r.status for r in res.status.collect()] == ["SKIP_DUPLICATE"]
    assert res.written.rows_written == 0


def test_single_file_report_lands_at_exact_name(spark, tmp_dir):
    spark.range(5).selectExpr("id", "CAST(id * 2 AS STRING) AS v").createOrReplaceTempView("rep_one")
    spec = ReportSpec(name="One File", source="rep_one", columns=["id", "v"], filename_pattern="one_{file_date}.csv",
                      csv=CsvSpec(delimiter="|"), single_file=True)
    st = run_reports(spark, [spec], {"file_date": "2024-01-01"}, tmp_dir).first()
    assert st.success and os.path.isfile(st.path)
    with open(st.path) as fh:
        lines = fh.read().splitlines()
    assert lines[0] == "id|v" and len(lines) == 6
    bad = ReportSpec(name="Idx", source="rep_one", columns=["id"], csv=CsvSpec(index=True))
    assert "index" in run_reports(spark, [bad], {"file_date": "x"}, tmp_dir).first().error


def test_archive_lines_stream_in_chunks(spark, tmp_dir):
    from terrace.sources.files import archive_lines, archive_member_names
    _zip(f"{tmp_dir}/a/x.zip", {"m.csv": "h\n" + "\n".join(str(i) for i in range(25)) + "\n", "d/": ""})
    files = list_files(spark, f"{tmp_dir}/a", "*.zip", with_content=True)
    lines = archive_lines(files, "zip", chunk=7).collect()
    assert [r.n for r in lines] == list(range(26)) and lines[0].line == "h" and lines[-1].line == "24"
    assert [r.member for r in archive_member_names(files, "zip").collect()] == ["m.csv"]


def test_landing_names_with_spaces_and_plus(spark, tmp_dir):
    write(f"{tmp_dir}/land/sales 2024-01-05.csv", "id,name\n1,a\n2,b\n")
    write(f"{tmp_dir}/land/sales+x_2024-01-06.csv", "id,name\n3,c\n")
    spec = LandingSpec(filename_pattern=r"sales.*\.csv")
    raw = TableSpec(f"{tmp_dir}/raw", partition_field="data_date")
    res = land(spark, f"{tmp_dir}/land", spec, raw, columns=["id", "name"])
    assert sorted(r.status for r in res.status.collect()) == ["PROCESSED", "PROCESSED"]
    assert res.written.rows_written == 3 and raw.schema is None


def test_landing_unreadable_archive_and_preamble(spark, tmp_dir):
    _zip(f"{tmp_dir}/land/A_20240105.ZIP", {"m.csv": "x,y\n1,2\n"})
    write(f"{tmp_dir}/land/B_20240106.ZIP", "not a zip")
    write(f"{tmp_dir}/land/README.txt", "ignored")
    spec = LandingSpec(filename_pattern=r"[AB]_\d{8}\.ZIP", zipped="zip", date_regex=r"(\d{4})(\d{2})(\d{2})")
    res = land(spark, f"{tmp_dir}/land", spec, TableSpec(f"{tmp_dir}/raw"), columns=["x", "y"])
    st = {r.file_name: r.status for r in res.status.collect()}
    assert st == {"A_20240105.ZIP": "PROCESSED", "B_20240106.ZIP": "ERROR", "README.txt": "SKIP_PATTERN"}
    write(f"{tmp_dir}/land2/p_2024-02-01.csv", "exported by tool\nid,name\n1,a\n")
    spec2 = LandingSpec(filename_pattern=r"p_.*\.csv", csv=CsvSpec(header_position=1))
    raw2 = TableSpec(f"{tmp_dir}/raw2", partition_field="data_date")
    res2 = land(spark, f"{tmp_dir}/land2", spec2, raw2, columns=["id", "name"])
    assert [tuple(r) for r in read_target(spark, res2.table).collect()] == [("1", "a", "2024-02-01")]


def test_landing_zip_without_header(spark, tmp_dir):
    _zip(f"{tmp_dir}/land/Z_20240105.ZIP", {"m.csv": "1,a\n2,b\n"})
    spec = LandingSpec(filename_pattern=r"Z_.*", zipped="zip", date_regex=r"(\d{4})(\d{2})(\d{2})",
                       csv=CsvSpec(header=False))
    raw = TableSpec(f"{tmp_dir}/raw", partition_field="data_date")
    res = land(spark, f"{tmp_dir}/land", spec, raw, columns=["id", "v"], checks=())
    assert sorted(tuple(r) for r in read_target(spark, res.table).collect()) == [("1", "a", "2024-01-05"), ("2", "b", "2024-01-05")]


def test_landing_latin1_preamble_and_comments(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/land")
    with open(f"{tmp_dir}/land/p_2024-03-01.csv", "wb") as fh:
        fh.write("exported by tool\nid,name\n# a comment\n1,José\n".encode("latin-1"))
    spec = LandingSpec(filename_pattern=r"p_.*\.csv", csv=CsvSpec(header_position=1, encoding="ISO-8859-1", comment="#"))
    res = land(spark, f"{tmp_dir}/land", spec, TableSpec(f"{tmp_dir}/raw", partition_field="data_date"),
               columns=["id", "name"])
    assert [r.status for r in res.status.collect()] == ["PROCESSED"]
    assert [tuple(r) for r in read_target(spark, res.table).collect()] == [("1", "José", "2024-03-01")]


def test_landing_headerless_files_with_default_checks(spark, tmp_dir):
    write(f"{tmp_dir}/land/h_2024-03-01.csv", "1,a\n2,b\n")
    write(f"{tmp_dir}/land/h_2024-03-02.csv", "3,c,x\n")
    spec = LandingSpec(filename_pattern=r"h_.*\.csv", csv=CsvSpec(header=False))
    res = land(spark, f"{tmp_dir}/land", spec, TableSpec(f"{tmp_dir}/raw", partition_field="data_date"),
               columns=["id", "v"])
    st = {r.file_name: r.status for r in res.status.collect()}
    assert st == {"h_2024-03-01.csv": "PROCESSED", "h_2024-03-02.csv": "ERROR"}
    assert sorted(tuple(r) for r in read_target(spark, res.table).collect()) == [("1", "a", "2024-03-01"), ("2", "b", "2024-03-01")]


def test_landing_corrupt_member_is_reported(spark, tmp_dir):
    _zip(f"{tmp_dir}/land/C_20240105.ZIP", {"m.csv": "x,y\n" + "1,2\n" * 2000})
    data = bytearray(open(f"{tmp_dir}/land/C_20240105.ZIP", "rb").read())
    data[60] ^= 0xFF                                   # corrupt the member's stored bytes
    open(f"{tmp_dir}/land/C_20240105.ZIP", "wb").write(bytes(data))
    _zip(f"{tmp_dir}/land/C_20240106.ZIP", {"m.csv": "x,y\n3,4\n"})
    spec = LandingSpec(filename_pattern=r"C_\d{8}\.ZIP", zipped="zip", date_regex=r"(\d{4})(\d{2})(\d{2})")
    res = land(spark, f"{tmp_dir}/land", spec, TableSpec(f"{tmp_dir}/raw"), columns=["x", "y"])
    st = {r.file_name: r.status for r in res.status.collect()}
    assert st == {"C_20240105.ZIP": "ERROR", "C_20240106.ZIP": "PROCESSED"}
    assert [tuple(r) for r in read_target(spark, res.table).collect()] == [("3", "4", "2024-01-06")]


def test_archive_names_with_glob_characters(spark, tmp_dir):
    _zip(f"{tmp_dir}/land/C_20240105[1].zip", {"m.csv": "x,y\n1,2\n"})
    spec = LandingSpec(filename_pattern=r"C_\d{8}.*\.zip", zipped="zip", date_regex=r"(\d{4})(\d{2})(\d{2})")
    res = land(spark, f"{tmp_dir}/land", spec, TableSpec(f"{tmp_dir}/raw"), columns=["x", "y"])
    assert [r.status for r in res.status.collect()] == ["PROCESSED"]
    assert [tuple(r) for r in read_target(spark, res.table).collect()] == [("1", "2", "2024-01-05")]


@pytest.mark.parametrize("zipped,encoding", [(None, "UTF-8"), ("zip", "UTF-8"), (None, "ISO-8859-1")])
def test_header_position_counts_content_lines(spark, tmp_dir, zipped, encoding):
    text = "# generated\n\ntool v1\nid,name\n1,a\n"
    csv = CsvSpec(header_position=1, comment="#", encoding=encoding)
    if zipped:
        _zip(f"{tmp_dir}/land/p_20240301.zip", {"m.csv": text})
        spec = LandingSpec(filename_pattern=r"p_.*", zipped="zip", csv=csv, date_regex=r"(\d{4})(\d{2})(\d{2})")
    else:
        os.makedirs(f"{tmp_dir}/land")
        with open(f"{tmp_dir}/land/p_20240301.csv", "wb") as fh:
            fh.write(text.encode(encoding))
        spec = LandingSpec(filename_pattern=r"p_.*", csv=csv, date_regex=r"(\d{4})(\d{2})(\d{2})")
    res = land(spark, f"{tmp_dir}/land", spec, TableSpec(f"{tmp_dir}/raw"), columns=["id", "name"])
    assert [(r.status, r.error) for r in res.status.collect()] == [("PROCESSED", "")]
    assert [tuple(r) for r in read_target(spark, res.table).collect()] == [("1", "a", "2024-03-01")]


def test_headerless_format_check_needs_column_count(spark, tmp_dir):
    write(f"{tmp_dir}/in/a.csv", "1,2\n1,2,3\n")
    with pytest.raises(ValueError):
        check_csv_format(spark, f"{tmp_dir}/in", CsvSpec(header=False)).collect()
    assert [r.result for r in check_csv_format(spark, f"{tmp_dir}/in", CsvSpec(header=False), n_columns=2).collect()] == [False]


def test_landing_folder_named_with_glob_characters(spark, tmp_dir):
    write(f"{tmp_dir}/land[1]/d_2024-01-05.csv", "id,name\n1,a\n\t\n")
    write(f"{tmp_dir}/land[1]/d_2024-01-06.csv", "tool\n\t\nid,name\n2,b\n")
    spec = LandingSpec(filename_pattern=r"d_.*\.csv")
    res = land(spark, f"{tmp_dir}/land[1]", spec, TableSpec(f"{tmp_dir}/raw", partition_field="data_date"),
               columns=["id", "name"])
    st = {r.file_name: r.status for r in res.status.collect()}
    assert st["d_2024-01-05.csv"] == "PROCESSED"     # a tab-only line is blank
    assert [tuple(r) for r in read_target(spark, res.table).where("data_date = '2024-01-05'").collect()] == [("1", "a", "2024-01-05")]
    spec1 = LandingSpec(filename_pattern=r"d_2024-01-06\.csv", csv=CsvSpec(header_position=1))
    res1 = land(spark, f"{tmp_dir}/land[1]", spec1, TableSpec(f"{tmp_dir}/raw1", partition_field="data_date"),
                columns=["id", "name"])
    assert [tuple(r) for r in read_target(spark, res1.table).collect()] == [("2", "b", "2024-01-06")]


def test_raw_keeps_repeated_rows_and_files_of_one_date(spark, tmp_dir):
    spec = LandingSpec(filename_pattern=r"(ESP|FRA)_.*\.csv")
    raw = TableSpec(f"{tmp_dir}/raw", partition_field="data_date")
    write(f"{tmp_dir}/one/ESP_2024-01-05.csv", "id,v\n1,a\n1,a\n2,b\n")
    land(spark, f"{tmp_dir}/one", spec, raw, columns=["id", "v"])
    write(f"{tmp_dir}/two/FRA_2024-01-05.csv", "id,v\n3,c\n")
    res = land(spark, f"{tmp_dir}/two", spec, raw, columns=["id", "v"])
    rows = lambda: sorted(tuple(r) for r in read_target(spark, res.table, with_source=True).select("id", "source_file").collect())
    assert rows() == [("1", "ESP_2024-01-05.csv"), ("1", "ESP_2024-01-05.csv"), ("2", "ESP_2024-01-05.csv"), ("3", "FRA_2024-01-05.csv")]
    write(f"{tmp_dir}/three/ESP_2024-01-05.csv", "id,v\n9,z\n")
    assert land(spark, f"{tmp_dir}/three", spec, raw, columns=["id", "v"]).written.rows_written == 1
    assert rows() == [("3", "FRA_2024-01-05.csv"), ("9", "ESP_2024-01-05.csv")]


def test_unreadable_files_are_errors_and_the_others_land(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/land")
    for day in ("01", "02", "03"):
        spark.createDataFrame([(day, 1)], "id string, n int").coalesce(1).write.parquet(f"{tmp_dir}/p{day}")
        part = next(n for n in os.listdir(f"{tmp_dir}/p{day}") if n.startswith("part-"))
        os.rename(f"{tmp_dir}/p{day}/{part}", f"{tmp_dir}/land/d_2024-01-{day}.parquet")
    write(f"{tmp_dir}/land/d_2024-01-04.parquet", "not parquet at all")
    write(f"{tmp_dir}/land/notes.txt", "hello")
    res = land(spark, f"{tmp_dir}/land", LandingSpec(filename_pattern=r"d_.*\.parquet", file_format="parquet"), TableSpec(f"{tmp_dir}/raw"))
    st = {r.file_name: (r.status, r.error) for r in res.status.collect()}
    assert {n: s for n, (s, _) in st.items()} == {"d_2024-01-01.parquet": "PROCESSED", "d_2024-01-02.parquet": "PROCESSED",
                                                  "d_2024-01-03.parquet": "PROCESSED", "d_2024-01-04.parquet": "ERROR", "notes.txt": "SKIP_PATTERN"}
    assert "d_2024-01-04" in st["d_2024-01-04.parquet"][1]
    assert sorted(r.id for r in read_target(spark, res.table).collect()) == ["01", "02", "03"] and res.written.rows_written == 3


def test_whole_json_documents_and_a_wrong_level(spark, tmp_dir):
    write(f"{tmp_dir}/land/j_2024-01-01.json", '{\n  "rows": [\n    {"a": 1},\n    {"a": 2}\n  ]\n}\n')
    write(f"{tmp_dir}/land/j_2024-01-02.json", '{"rows": {"a": 3}}')
    write(f"{tmp_dir}/land/j_2024-01-03.json", '{"other": []}')
    write(f"{tmp_dir}/land/j_2024-01-04.json", '{"rows": [{"a": 4}]}')
    res = land(spark, f"{tmp_dir}/land", LandingSpec(filename_pattern=r"j_.*", file_format="json", json=JsonSpec("rows")), TableSpec(f"{tmp_dir}/raw"), columns=["a"])
    assert {r.file_name[10:12]: r.status for r in res.status.collect()} == {"01": "PROCESSED", "02": "ERROR", "03": "ERROR", "04": "PROCESSED"}
    assert sorted(r.a for r in read_target(spark, res.table).collect()) == ["1", "2", "4"]
    os.makedirs(f"{tmp_dir}/top")
    with open(f"{tmp_dir}/top/t_2024-01-01.json", "wb") as fh:
        fh.write('[\n {"a": "é"},\n {"a": "b"}\n]'.encode("latin-1"))
    res = land(spark, f"{tmp_dir}/top", LandingSpec(filename_pattern=r"t_.*", file_format="json", json=JsonSpec(encoding="ISO-8859-1")), TableSpec(f"{tmp_dir}/raw2"), columns=["a"])
    assert sorted(r.a for r in read_target(spark, res.table).collect()) == ["b", "é"]


def test_csv_checks_follow_the_readers_quotes_and_line_breaks(spark, tmp_dir):
    write(f"{tmp_dir}/q/d_2024-01-01.csv", "id,name\n1,'a,b'\n")
    res = land(spark, f"{tmp_dir}/q", LandingSpec(filename_pattern=r"d_.*", csv=CsvSpec(quote="'")), TableSpec(f"{tmp_dir}/raw"), columns=["id", "name"])
    assert [r.status for r in res.status.collect()] == ["PROCESSED"] and read_target(spark, res.table).first().name == "a,b"
    write(f"{tmp_dir}/m/d_2024-01-01.csv", 'id,"na""me"\n1,"a,\nb,c,d"\n2,x\n')
    write(f"{tmp_dir}/m/d_2024-01-02.csv", 'id,name\n1,"a\nb",extra\n')
    res = land(spark, f"{tmp_dir}/m", LandingSpec(filename_pattern=r"d_.*", csv=CsvSpec(multiline=True)), TableSpec(f"{tmp_dir}/raw2"), columns=["id", "name"])
    assert {r.file_name: r.status for r in res.status.collect()} == {"d_2024-01-01.csv": "PROCESSED", "d_2024-01-02.csv": "ERROR"}
    assert sorted(r.name for r in read_target(spark, res.table).collect()) == ["a,\nb,c,d", "x"]


def test_landing_rules_decide_what_stops(spark, tmp_dir):
    from terrace.quality.rules import rules_frame
    write(f"{tmp_dir}/land/d_2024-01-01.csv", "id,name\n1,a\n")
    write(f"{tmp_dir}/land/d_2024-01-02.csv", "id,name\n1,a,long\n")
    write(f"{tmp_dir}/land/d_2024-01-03.csv", "id,other\n1,a\n")
    base = dict(control_master_id="M", control_level="File", control_algorithm_type="SQL", control_threshold_type="Binary")
    rules = rules_frame(spark, [
        base | dict(control_table_id="format", blocking_control_indicator=True, control_description="SELECT path AS identifier, format_ok AS result FROM data"),
        base | dict(control_table_id="columns", blocking_control_indicator=False, control_description="SELECT path AS identifier, columns_ok AS result FROM data")])
    results = TableSpec(f"{tmp_dir}/results", partition_field="data_date")
    res = land(spark, f"{tmp_dir}/land", LandingSpec(filename_pattern=r"d_.*"), TableSpec(f"{tmp_dir}/raw"), columns=["id", "name"], rules=rules, results=results)
    assert {r.file_name: r.status for r in res.status.collect()} == {"d_2024-01-01.csv": "PROCESSED", "d_2024-01-02.csv": "ERROR", "d_2024-01-03.csv": "PROCESSED"}
    assert {r.control_table_id: r.control_outcome for r in read_target(spark, results).collect()} == {
        "format": "{total: 3, value: 1}", "columns": "{total: 3, value: 1}"}
    assert res.controls.verdict() is False


def test_streams_refuse_headers_below_the_first_line(spark, tmp_dir):
    from terrace.streaming.landing_stream import landing_stream
    with pytest.raises(ValueError):
        landing_stream(spark, tmp_dir, LandingSpec(filename_pattern=".*", csv=CsvSpec(header_position=1)), ["a"])


def test_expand_archives_yields_members_one_by_one(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/z")
    _zip(f"{tmp_dir}/z/a.zip", {"x.csv": "1", "y.csv": "2"})
    files = list_files(spark, f"{tmp_dir}/z", "*.zip", with_content=True)
    got = [(r.member, bytes(r.content), r.validate) for r in expand_archives(files, "zip", include_archive=True).collect()]
    assert [g[0] for g in got] == ["a.zip", "x.csv", "y.csv"] and got[1][1] == b"1" and got[0][2] is False


def test_failing_reports_are_named_and_the_others_written(spark, tmp_dir):
    spark.createDataFrame([(1, "a")], "id int, v string").write.parquet(f"{tmp_dir}/src")
    spec = lambda name, **kw: ReportSpec(name=name, source=f"{tmp_dir}/src", columns=["id"], csv=CsvSpec(), filename_pattern="{name}.csv", **kw)
    st = {r.name: r for r in run_reports(spark, [spec("good"), spec("none", where="id > 5"), spec("bad", where="nope = 1")], {}, f"{tmp_dir}/out").collect()}
    assert st["good"].success and not st["none"].success and "no data" in st["none"].error and not st["bad"].success and "nope" in st["bad"].error


def test_strict_reports_raise_after_all_ran(spark, tmp_dir):
    from terrace.plans.reports import ReportError
    spark.createDataFrame([(1, "a")], "id int, v string").write.parquet(f"{tmp_dir}/src")
    specs = [ReportSpec(name=n, source=f"{tmp_dir}/src", columns=["id"], csv=CsvSpec(), filename_pattern="{name}.csv", where=w) for n, w in (("bad", "nope = 1"), ("good", None))]
    with pytest.raises(ReportError, match="bad"):
        run_reports(spark, specs, {}, f"{tmp_dir}/out", strict=True)
    assert os.path.isdir(f"{tmp_dir}/out/good/inbound/good.csv")


def test_stored_hashes_spare_the_archive(spark):
    incoming = spark.createDataFrame([("in/a.csv", "a.csv", "1"), ("in/b.csv", "b.csv", "2")], "path string, file_name string, content string")
    known = spark.createDataFrame([("p/insert_date=2024-01-02/insert_time=01:00:00/a.csv", "a.csv", "c4ca4238a0b923820dcc509a6f75849b"),
                                   ("p/insert_date=2024-01-01/insert_time=01:00:00/b.csv", "b.csv", "c81e728d9d4c2f636f067f89cc14862c"),
                                   ("p/insert_date=2024-01-02/insert_time=01:00:00/b.csv", "b.csv", "other")], "path string, file_name string, content_md5 string")
    assert {r.file_name: r.is_duplicate for r in flag_unchanged(incoming, known).collect()} == {"a.csv": True, "b.csv": False}


# ------------------------------------------------------------------ deliveries


def _rows(spark, res, *cols):
    return sorted(tuple(r) for r in read_target(spark, res.table, with_source=True).select(*cols).collect())


@pytest.mark.parametrize("each", [1, 2, 5000])
def test_equal_names_in_two_folders_do_not_depend_on_batches(spark, tmp_dir, each):
    write(f"{tmp_dir}/land/a/d_2024-01-05.csv", "id,v\n1,a\n")
    write(f"{tmp_dir}/land/b/d_2024-01-05.csv", "id,v\n2,b\n")
    spec = LandingSpec(filename_pattern=r"d_.*")
    res = land(spark, f"{tmp_dir}/land", spec, TableSpec(f"{tmp_dir}/raw"), columns=["id", "v"], files_per_batch=each)
    assert res.written.rows_written == 2 and res.written.files_added == 2
    assert _rows(spark, res, "id", "source_file") == [("1", "a/d_2024-01-05.csv"), ("2", "b/d_2024-01-05.csv")]


def test_a_delivery_replaces_all_it_brought_before(spark, tmp_dir):
    spec = LandingSpec(filename_pattern=r"d_.*", date_column="d")
    raw = TableSpec(f"{tmp_dir}/raw")

    def deliver(text, n):
        write(f"{tmp_dir}/in{n}/d_2024-01-01.csv", text)
        return land(spark, f"{tmp_dir}/in{n}", spec, raw, columns=["id", "d"])
    write(f"{tmp_dir}/other/d_2024-01-09.csv", "id,d\n7,2024-01-02\n")
    land(spark, f"{tmp_dir}/other", spec, raw, columns=["id", "d"])
    assert _rows(spark, deliver("id,d\n1,2024-01-01\n2,2024-01-02\n", 1), "id", "data_date") == [("1", "2024-01-01"), ("2", "2024-01-02"), ("7", "2024-01-02")]
    again = deliver("id,d\n3,2024-01-01\n4,2024-01-03\n", 2)
    assert _rows(spark, again, "id", "data_date") == [("3", "2024-01-01"), ("4", "2024-01-03"), ("7", "2024-01-02")]
    assert (again.written.files_added, again.written.files_removed) == (2, 2)
    empty = deliver("id,d\n", 3)
    assert [r.status for r in empty.status.collect()] == ["PROCESSED"] and _rows(spark, empty, "id") == [("7",)]
    assert not os.path.exists(f"{tmp_dir}/raw/data_date=2024-01-03")
    assert _rows(spark, deliver("id,d\n5,2024-01-04\n", 4), "id", "data_date") == [("5", "2024-01-04"), ("7", "2024-01-02")]


def test_a_failing_table_is_no_fault_of_the_files(spark, tmp_dir, monkeypatch):
    from terrace.plans import landing
    for day in range(1, 6):
        write(f"{tmp_dir}/land/d_2024-01-0{day}.csv", f"id,v\n{day},a\n")
    tries = []

    def full(*args, **kwargs):
        tries.append(1)
        raise OSError("disk full")
    monkeypatch.setattr(landing, "write_raw", full)
    with pytest.raises(OSError, match="disk full"):
        land(spark, f"{tmp_dir}/land", LandingSpec(filename_pattern=r"d_.*"), TableSpec(f"{tmp_dir}/raw"), columns=["id", "v"])
    assert len(tries) == 1


def test_a_landing_with_a_token_runs_once(spark, tmp_dir):
    write(f"{tmp_dir}/land/d_2024-01-05.csv", "id,v\n1,a\n")
    spec, raw = LandingSpec(filename_pattern=r"d_.*"), TableSpec(f"{tmp_dir}/raw")
    first = land(spark, f"{tmp_dir}/land", spec, raw, columns=["id", "v"], token="run-1")
    names = sorted(os.listdir(f"{tmp_dir}/raw/data_date=2024-01-05/source_file=d_2024-01-05.csv"))
    again = land(spark, f"{tmp_dir}/land", spec, raw, columns=["id", "v"], token="run-1")
    assert again.written == first.written and names == sorted(os.listdir(f"{tmp_dir}/raw/data_date=2024-01-05/source_file=d_2024-01-05.csv"))
    assert any(n.startswith("run-1-0-") for n in names)


def test_quotes_within_quotes_are_doubled(spark, tmp_dir):
    write(f"{tmp_dir}/land/d_2024-01-01.csv", 'id,name\n1,"x ""y"" , z"\n2,"plain"\n3,5" pipe\n')
    write(f"{tmp_dir}/land/d_2024-01-02.csv", 'id,name\n1,"x ""y"" , z",1\n')
    res = land(spark, f"{tmp_dir}/land", LandingSpec(filename_pattern=r"d_.*"), TableSpec(f"{tmp_dir}/raw"), columns=["id", "name"])
    assert {r.file_name: r.status for r in res.status.collect()} == {"d_2024-01-01.csv": "PROCESSED", "d_2024-01-02.csv": "ERROR"}
    assert _rows(spark, res, "id", "name") == [("1", 'x "y" , z'), ("2", "plain"), ("3", '5" pipe')]
    write(f"{tmp_dir}/slash/d_2024-01-01.csv", 'id,name\n1,"x \\" , z"\n')
    res = land(spark, f"{tmp_dir}/slash", LandingSpec(filename_pattern=r"d_.*", csv=CsvSpec(escape="\\")), TableSpec(f"{tmp_dir}/raw2"), columns=["id", "name"])
    assert _rows(spark, res, "id", "name") == [("1", 'x " , z')]


def test_field_counts_are_the_readers(spark):
    import random
    from pyspark.sql import functions as F
    from terrace.quality.files import _field_count
    rng = random.Random(2)
    for spec in (CsvSpec(), CsvSpec(quote="'", delimiter="|"), CsvSpec(delimiter="\t")):
        letters = [spec.quote or '"'] * 3 + [spec.delimiter] * 3 + ["a", " ", "\\"]
        lines = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(600)}
        options = {k: v for k, v in spec.read_options().items() if k not in ("header", "multiLine", "encoding")} | {"columnNameOfCorruptRecord": "bad"}

        def whole(k):
            return F.from_csv("line", ", ".join(f"c{i} string" for i in range(k)) + ", bad string", options)["bad"].isNull()
        width = F.coalesce(*[F.when(whole(k), F.lit(k)) for k in range(1, 11)])
        df = spark.createDataFrame([(line,) for line in lines], "line string").select("line", width.alias("m"), _field_count(F.col("line"), spec).alias("n"))
        assert df.where("NOT m <=> n").collect() == []


@pytest.mark.parametrize("encoding", ["utf-8-sig", "utf-16"])
def test_json_with_a_byte_order_mark(spark, tmp_dir, encoding):
    os.makedirs(f"{tmp_dir}/land")
    with open(f"{tmp_dir}/land/j_2024-01-01.json", "wb") as fh:
        fh.write('{\n "rows": [{"a": "é"}]}'.encode(encoding))
    res = land(spark, f"{tmp_dir}/land", LandingSpec(filename_pattern=r"j_.*", file_format="json", json=JsonSpec("rows")), TableSpec(f"{tmp_dir}/raw"), columns=["a"])
    assert [(r.status, r.error) for r in res.status.collect()] == [("PROCESSED", "")] and _rows(spark, res, "a") == [("é",)]


def test_templates_fill_known_names_only(spark):
    assert fill_template("{a}{9} {b} {c}", {"a": 1, "c": None}) == "1{9} {b} None"
    assert fill_template("x{2}", {}) == "x{2}"
    assert fill_template("'{v}'", {"v": "{w}", "w": "no"}) == "'{w}'"   # a value is no template


@pytest.mark.parametrize("name,folder", [("Orders 2024 CSV", "orders_csv"), ("P & L Report", "p_l_report"), ("P & L 2024", "p_l"), ("My  Report!", "my_report"),
                                         (" a1b-c ", "abc"), ("Año", "ao"), ("2024", "")])
def test_report_folders(name, folder):
    assert output_folder(name) == folder


def test_controlled_stream_files_every_file_once(spark, tmp_dir, monkeypatch):
    from terrace.streaming import landing_stream
    write(f"{tmp_dir}/in/d_2024-01-01.csv", "id,v\n1,a\n1,a\n")
    write(f"{tmp_dir}/in/d_2024-01-02.csv", "id,v\n2,b,c\n")
    spec, raw, status = LandingSpec(filename_pattern=r"d_.*"), TableSpec(f"{tmp_dir}/raw"), TableSpec(f"{tmp_dir}/status", partition_field=None)

    def start():
        q = landing_stream.start_controlled_landing(spark, f"{tmp_dir}/in", spec, raw, ["id", "v"], status, checkpoint=f"{tmp_dir}/chk", max_files_per_trigger=10)
        q.awaitTermination()

    def lost(*args, **kwargs):
        raise OSError("lost")
    monkeypatch.setattr(landing_stream, "append", lost)
    with pytest.raises(Exception, match="lost"):
        start()                                   # rows are committed, statuses are not
    assert spark.read.parquet(f"{tmp_dir}/raw").count() == 2
    monkeypatch.undo()
    write(f"{tmp_dir}/in/e_2024-01-03.csv", "id,v\n3,c\n")
    write(f"{tmp_dir}/in/d_2024-01-04.csv", "id,v\n4,d\n")
    start()
    start()
    assert sorted((r.file_name, r.status, r.batch) for r in spark.read.parquet(status.path).collect()) == [
        ("d_2024-01-01.csv", "PROCESSED", 0), ("d_2024-01-02.csv", "ERROR", 0), ("d_2024-01-04.csv", "PROCESSED", 1), ("e_2024-01-03.csv", "SKIP_PATTERN", 1)]
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_dir}/raw").collect()) == ["1", "1", "4"]


def test_a_committed_batch_knows_the_files_it_left_out(spark, tmp_dir):
    write(f"{tmp_dir}/land/j_2024-01-01.json", '{"rows": [{"a": 1}]}')
    write(f"{tmp_dir}/land/j_2024-01-02.json", '{"rows": 5}')
    spec, raw = LandingSpec(filename_pattern=r"j_.*", file_format="json", json=JsonSpec("rows")), TableSpec(f"{tmp_dir}/raw")
    runs = [land(spark, f"{tmp_dir}/land", spec, raw, columns=["a"], token="t") for _ in range(2)]
    for res in runs:
        assert {r.file_name: r.status for r in res.status.collect()} == {"j_2024-01-01.json": "PROCESSED", "j_2024-01-02.json": "ERROR"}
    assert runs[0].written == runs[1].written


# ------------------------------------------------------------------ archives by range


def _tar(path, members, mode="w"):
    import tarfile
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with tarfile.open(path, mode) as t:
        folder = tarfile.TarInfo("sub")
        folder.type = tarfile.DIRTYPE
        t.addfile(folder)
        for name, text in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(text.encode())
            t.addfile(info, io.BytesIO(text.encode()))


@pytest.mark.parametrize("kind,mode", [("zip", None), ("tar", "w"), ("tar", "w:gz")])
def test_members_are_read_by_tasks_of_their_own(spark, tmp_dir, kind, mode):
    from pyspark.sql import functions as F
    from terrace.sources.files import archive_contents, archive_directory, member_contents
    members = {f"sub/m{i}.csv": "id,v\n\n" + "".join(f"{i},{j}\n" for j in range(i)) for i in range(40)} | {"empty.csv": ""}
    path = f"{tmp_dir}/a/big 1.{kind}"
    _zip(path, members) if kind == "zip" else _tar(path, members, mode)
    files = list_files(spark, f"{tmp_dir}/a")
    directory = archive_directory(files, kind)
    assert sorted(r.member for r in directory.collect()) == sorted(members)
    got = member_contents(directory, kind)
    tasks = got.select(F.spark_partition_id().alias("p"), "member").distinct().collect()
    assert len({t.p for t in tasks}) > 5 and len(tasks) == len(members)      # many tasks, a member in one each
    want = {(m, n, line) for m, text in members.items() for n, line in enumerate(x for x in text.splitlines() if x)}
    for rows in (got, archive_contents(list_files(spark, f"{tmp_dir}/a", with_content=True), kind)):
        found = rows.collect()
        assert {(r.member, r.n, r.line) for r in found if r.n >= 0} == want
        assert sorted((r.member, r.error) for r in found if r.n < 0) == sorted((m, None) for m in members)


def test_members_of_a_small_archive_are_read_together(spark, tmp_dir):
    from pyspark.sql import functions as F
    from terrace.sources.files import archive_directory, member_contents
    for a in range(60):
        _zip(f"{tmp_dir}/a/{a}.zip", {f"m{i}.csv": f"{a},{i}\n" for i in range(8)})
    got = member_contents(archive_directory(list_files(spark, f"{tmp_dir}/a"), "zip"), "zip").where("n >= 0")
    at = got.select(F.spark_partition_id().alias("p"), "archive", "member", "line").collect()
    assert sorted(r.line for r in at) == sorted(f"{a},{i}" for a in range(60) for i in range(8))
    parts = {}
    for r in at:
        parts.setdefault(r.archive, set()).add(r.p)
    assert len(parts) == 60 and max(map(len, parts.values())) <= 2                # opened by one task, or by two where lots meet
    assert len(set().union(*parts.values())) > 5                                  # all of them by many
    order = sorted(parts, key=lambda a: a.encode())
    assert all(max(parts[x]) <= min(parts[y]) for x, y in zip(order, order[1:]))   # so a batch of archives is in few parts


@pytest.mark.parametrize("kind,mode", [("zip", None), ("tar", "w"), ("tar", "w:gz")])
def test_an_archive_is_opened_once_for_its_members(tmp_dir, kind, mode):
    from terrace.sources.files import _directory, _streamed
    path, opened = f"{tmp_dir}/x.{kind}", []
    members = {f"m{i}.csv": f"{i}\n" for i in range(9)}
    _zip(path, members) if kind == "zip" else _tar(path, members, mode)

    def opening():
        opened.append(open(path, "rb"))
        return opened[-1]
    with open(path, "rb") as raw:
        places = [(name, place) for name, place, _ in _directory(kind, raw)]
    rows = list(_streamed("x", places, kind, opening, "utf-8", None))
    assert [r[3] for r in rows if r[2] >= 0] == list(map(str, range(9))) and not any(r[4] for r in rows)
    assert len(opened) == 1 and opened[0].closed


def test_many_small_files_are_written_by_many_tasks(spark, tmp_dir):
    from terrace.plans.landing import SMALL_FILE, _write_tasks
    assert _write_tasks(spark, [("a", 10)] * 5000) >= 100
    assert _write_tasks(spark, [("a", 10)] * 3 + [("b", SMALL_FILE + 1)]) is None
    for i in range(40):
        _zip(f"{tmp_dir}/in/Z_{i}_20240101.zip", {"m.csv": f"id,v\n{i},1\n{i},1\n"})
    spec = LandingSpec(filename_pattern=r"Z_.*", zipped="zip", date_regex=r"(\d{4})(\d{2})(\d{2})")
    raw = TableSpec(f"{tmp_dir}/raw", partition_field="data_date")
    for _ in range(2):   # the second delivery replaces the first
        res = land(spark, f"{tmp_dir}/in", spec, raw, columns=["id", "v"], files_per_batch=25)
        rows = read_target(spark, res.table, with_source=True).collect()
        assert sorted((r.id, r.source_file) for r in rows) == sorted((str(i), f"Z_{i}_20240101.zip") for i in range(40) for _ in range(2))
        assert res.written.files_added == 40


def test_damage_is_told_by_member(spark, tmp_dir):
    from terrace.sources.files import archive_directory, member_contents
    _zip(f"{tmp_dir}/a/x.zip", {"good.csv": "1\n", "bad.csv": "2\n" * 3000})
    raw = bytearray(open(f"{tmp_dir}/a/x.zip", "rb").read())
    at = raw.index(b"bad.csv") + 12
    raw[at] ^= 0xFF
    open(f"{tmp_dir}/a/x.zip", "wb").write(bytes(raw))
    write(f"{tmp_dir}/a/y.zip", "no archive")
    found = member_contents(archive_directory(list_files(spark, f"{tmp_dir}/a"), "zip"), "zip").where("n < 0").collect()
    errors = {(r.archive[-5:], r.member): r.error or "" for r in found}
    assert errors["x.zip", "good.csv"] == "" and "CRC" in errors["x.zip", "bad.csv"] and errors["y.zip", None]


@pytest.mark.parametrize("block", [40, 97, 1 << 20])
def test_records_that_span_lines_are_profiled_by_blocks(spark, tmp_dir, block):
    import csv
    import random
    from terrace.quality.files import csv_profile
    rng = random.Random(block)
    want = {}
    os.makedirs(f"{tmp_dir}/in")
    for i in range(6):
        buf = io.StringIO(newline="")
        w = csv.writer(buf, lineterminator="\n")
        w.writerow(["id", 'na"me', "x"])
        for j in range(rng.randrange(60)):
            w.writerow(["".join(rng.choice(["a", "b c", ",", '"', "\n", "", "é"]) for _ in range(rng.randrange(9))) for _ in range(rng.choice([1, 2, 3, 3, 3, 4]))])
        text = buf.getvalue()
        with open(f"{tmp_dir}/in/f{i}.csv", "w", newline="") as fh:
            fh.write(text)
        records = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
        want[f"f{i}.csv"] = (max([len(r) for r in records[1:]], default=0), len(records) - 1)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = csv_profile(spark, f"{tmp_dir}/in", CsvSpec(multiline=True)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {r.path.rsplit("/", 1)[-1]: (r.max_width, r["rows"]) for r in got} == want
    assert {r.header for r in got} == {'id,"na""me",x'}
