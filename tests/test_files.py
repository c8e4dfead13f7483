from __future__ import annotations

import datetime as dt
import gzip
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from namelens.plans import download
from namelens.sources import export, files
from namelens.sources.export import export_batch, export_batches, read_export


def stamp():
    return F.lit("2026-04-10 12:00:00").cast("timestamp_ntz")


def write_upload(folder, org, batch, name, lines, header="id,first,last,zip"):
    path = folder / f"client_{org}" / f"batch_{batch}"
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join([header, *lines]) + "\n")


def test_client_files_are_read_by_position(spark, tmp_path):
    write_upload(tmp_path, "a", "1", "u_x.csv", ["1,Ann,Lee,98101", '2,"O, Neil",,'], "zip,whatever,b,c")
    landed = files.to_landing(files.read_client_csv(spark, str(tmp_path)), stamp())
    out = sorted((r.record_id, r.first_name, r.last_name, r.zip, r.file_record_row_number) for r in landed.collect())
    assert out == [("1", "Ann", "Lee", "98101", 1), ("2", "O, Neil", None, None, 2)]


def test_quotes_can_be_kept(spark, tmp_path):
    write_upload(tmp_path, "a", "1", "u_x.csv", ['1,"Ann",Lee,98101'])
    assert files.read_client_csv(spark, str(tmp_path), quote="").first().first_name == '"Ann"'


def test_row_numbers_over_a_split_file(spark, tmp_path):
    write_upload(tmp_path, "a", "1", "u_x.csv", [f"{i},name{i},last,{i}" for i in range(1, 5001)])
    write_upload(tmp_path, "b", "2", "u_y.csv", [f"{i},n{i},last,{i}" for i in range(1, 301)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        read = files.read_client_csv(spark, str(tmp_path))
        assert read.select("storage_file_name", "_block").distinct().count() > 10
        landed = files.to_landing(read, stamp())
        assert landed.count() == 5300
        assert landed.where("cast(record_id as bigint) <> file_record_row_number").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_batch_file_by_hand(spark, tmp_path):
    write_upload(tmp_path, "a", "1", "keep_x.csv", ["1,Ann,Lee,98101"])
    write_upload(tmp_path, "a", "1", "other.csv", ["2,Bob,Lee,98101"])
    out = files.read_batch_file(spark, str(tmp_path), 7, 70, stamp(), glob="keep_*.csv").collect()
    assert [(r.client_id, r.batch_id, r.record_id) for r in out] == [(7, 70, "1")]
    listed = files.list_files(spark, str(tmp_path), r".*keep_x\.csv$")
    assert [r.path.split("/")[-1] for r in listed.collect()] == ["keep_x.csv"]


def test_voter_file(spark, tmp_path):
    head = "|".join(f"c{i}" for i in range(33))

    def line(voter, name, year, registered):
        fields = [voter, name, "", "Núñez", "", year, "F"] + [""] * 10 + ["98101-0001"] + [""] * 12
        return "|".join(fields + [registered, "2020-01-02", "Active"])

    text = "\n".join([head, line("12", "José", "1980", "12/31/2019"), line("x1", "Ann", "old", "never")])
    path = tmp_path / "roll.txt.gz"
    path.write_bytes(gzip.compress(text.encode("iso-8859-1")))
    out = files.read_voter_file(spark, str(path), stamp()).orderBy("first_name").collect()
    ann, jose = out
    assert (jose.state_voter_id, jose.first_name, jose.last_name, jose.birth_year) == (12, "José", "Núñez", 1980)
    assert jose.registration_date == dt.date(2019, 12, 31) and jose.last_voted_date == dt.date(2020, 1, 2)
    assert (ann.state_voter_id, ann.birth_year, ann.registration_date, ann.status_code) == (None, None, None, "Active")
    assert len(out[0]) == 34


def test_name_counts_file(spark, tmp_path):
    (tmp_path / "n.csv").write_text("name,sex,count,year\nAnn,F,12,1990\n")
    assert tuple(files.read_name_counts(spark, str(tmp_path)).first()) == ("Ann", "F", Decimal(12), 1990)


def test_missing_record_ids_are_stable(rows):
    df = rows([(None, "f", 1), ("x", "f", 2), (None, "f", 3)], "record_id string, file string, n bigint")
    a = [r.record_id for r in files.fill_record_ids(df, "file", "n").orderBy("n").collect()]
    b = [r.record_id for r in files.fill_record_ids(df.repartition(5), "file", "n").orderBy("n").collect()]
    assert a == b and a[1] == "x" and len(set(a)) == 3


DOWNLOAD = (
    "app_organization_id string, app_batch_id string, client_id bigint, batch_id bigint, record_id string, "
    "first_name string, last_name string, zip string, male_probability decimal(10,6), "
    "female_probability decimal(10,6), gender_confidence_level string, predicted_gender string"
)
PEOPLE = [
    ("o1", "b1", 1, 10, "1", 'Ann "A", x', None, "98101", Decimal("0.1"), Decimal("0.9"), "HIGH", "F"),
    ("o1", "b2", 1, 11, "2", "Bob", "Lee", None, None, None, None, None),
]


def test_export_of_one_batch(rows, tmp_path):
    columns = ["RECORD_ID", "FIRST_NAME", "LAST_NAME", "FEMALE_PROBABILITY"]
    for _ in range(2):
        export_batch(rows(PEOPLE[:1], DOWNLOAD), str(tmp_path / "out.csv.gz"), columns, single_file=True)
    lines = gzip.decompress((tmp_path / "out.csv.gz").read_bytes()).decode().splitlines()
    assert lines == ["RECORD_ID,FIRST_NAME,LAST_NAME,FEMALE_PROBABILITY", '1,"Ann ""A"", x",,0.900000']
    with pytest.raises(ValueError):
        export_batch(rows(PEOPLE, DOWNLOAD), str(tmp_path / "no"), ["RECORD_ID", "1; drop"])


def test_a_batch_is_a_folder_at_every_size(rows, tmp_path, monkeypatch):
    people = rows(PEOPLE[:1], DOWNLOAD)
    for limit in (10, 10**9):
        monkeypatch.setattr(export, "MAX_SINGLE_FILE_BYTES", limit)
        export_batch(people, str(tmp_path / f"out{limit}"), ["RECORD_ID"])
        assert list((tmp_path / f"out{limit}").glob("part-*.csv.gz"))
    monkeypatch.setattr(export, "MAX_SINGLE_FILE_BYTES", 10)
    with pytest.raises(ValueError):
        export_batch(people, str(tmp_path / "no"), ["RECORD_ID"], single_file=True)


def test_rows_without_an_id_get_a_stable_one(spark, tmp_path):
    write_upload(tmp_path, "a", "1", "u_x.csv", [",Ann,Lee,98101", "  ,Bob,,", "7,Kim,,"])
    runs = [
        sorted(r.record_id for r in files.to_landing(files.read_client_csv(spark, str(tmp_path)), stamp()).collect())
        for _ in range(2)
    ]
    assert runs[0] == runs[1] and len(set(runs[0])) == 3 and "7" in runs[0]


def test_export_of_many_batches(spark, rows, tmp_path):
    export_batches(rows(PEOPLE, DOWNLOAD), str(tmp_path / "out"))
    back = {r.RECORD_ID: r for r in read_export(spark, str(tmp_path / "out")).collect()}
    assert back["1"].FIRST_NAME == 'Ann "A", x' and back["1"].app_batch_id == "b1"
    assert back["2"].ZIP is None and back["2"].PREDICTED_GENDER is None


CONFIG = "app_organization_id string, app_batch_id string, config_json string"


def test_configured_columns(rows):
    good = (
        '{"output_fields":[{"field_name":"ZIP","sort_order":2},{"field_name":"RECORD_ID","sort_order":null},'
        '{"field_name":"LAST_NAME"},{"field_name":null,"sort_order":0},{"field_name":"secret","sort_order":1}]}'
    )
    configs = rows([("o", "good", good), ("o", "none", "{}"), ("o", "bad", "{oops")], CONFIG)
    lists = {r.app_batch_id: r.select_list for r in download.config_select_list(configs).collect()}
    assert lists == {"good": "SRC.LAST_NAME, SRC.RECORD_ID, SRC.secret, SRC.ZIP"}
    assert download.ordered_columns(configs, "o", "good") == ["LAST_NAME", "RECORD_ID", "ZIP"]
    for batch in ("none", "bad", "unknown"):
        assert download.ordered_columns(configs, "o", batch) == list(download.EXPORT_COLUMNS)
