"""Corpus gates, suite definitions, writers."""

import pytest

from plimsoll.plans import bindings as X
from plimsoll.sources import reports
from plimsoll.sources.corpus import CorpusError, gate_report, land_corpus, load_corpus
from plimsoll.sources.stage import shared_folder, staged
from plimsoll.sources.suites import builtin_battery, builtin_battery_text, parse_suites, read_suites

HEADER = "id,comment_text,toxic,obscene\n"


def write(tmp_path, body, header=HEADER):
    path = tmp_path / "corpus.csv"
    path.write_text(header + body, encoding="utf-8")
    return str(path)


def test_load_reads_quoted_lines_and_adds_lengths(spark, tmp_path):
    path = write(tmp_path, '1,"two ""quoted""\nlines, here",1,0\n0002,plain,0,0\n')
    rows = {r["id"]: r for r in load_corpus(spark, path, ["toxic", "obscene"]).collect()}
    assert rows["1"]["comment_text"] == 'two "quoted"\nlines, here'
    assert (rows["1"]["char_len"], rows["1"]["word_len"], rows["1"]["toxic"]) == (24, 4, 1)
    assert "0002" in rows  # ids stay strings


def test_row_cap_and_landing(spark, tmp_path):
    df = load_corpus(spark, write(tmp_path, "3,c,0,0\n1,a,0,0\n2,b,1,0\n"), ["toxic", "obscene"], rows=2)
    assert sorted(r["id"] for r in df.collect()) == ["1", "2"]
    land_corpus(df, str(tmp_path / "landed"))
    assert load_corpus(spark, str(tmp_path / "landed"), ["toxic", "obscene"], fmt="parquet").count() == 2


@pytest.mark.parametrize("body, match", [
    ("1,a,0,0\n1,b,0,0\n1,c,0,0\n", r"unique_key\(id\): 2"),
    ("1,a,2,0\n2,b,0,0\n", r"binary_domain\(toxic\): 1"),
    ("1,a,,0\n2,b,0,\n", r"binary_domain\(toxic\): 1; binary_domain\(obscene\): 1"),
])
def test_gates_raise(spark, tmp_path, body, match):
    with pytest.raises(CorpusError, match=match):
        load_corpus(spark, write(tmp_path, body), ["toxic", "obscene"])


def test_missing_columns(spark, tmp_path):
    with pytest.raises(CorpusError, match="obscene"):
        load_corpus(spark, write(tmp_path, "1,a,0\n", "id,comment_text,toxic\n"), ["toxic", "obscene"])


def test_gate_report_on_empty_table(spark):
    df = spark.createDataFrame([], "id string, toxic int")
    assert {r["status"] for r in gate_report(df, ["toxic"]).collect()} == {"PASS"}


def test_suites_from_file_and_text_agree(spark):
    a = read_suites(spark, builtin_battery()).drop("expected").collect()
    b = parse_suites(spark, builtin_battery_text()).drop("expected").collect()
    assert a == b and [r["suite_ord"] for r in a] == list(range(7))


def test_read_or_compute(spark, tmp_path):
    path, calls = str(tmp_path / "t"), []

    def compute():
        calls.append(1)
        return spark.range(3)

    assert reports.read_or_compute(spark, path, compute).count() == 3
    assert reports.read_or_compute(spark, path, compute).count() == 3
    assert len(calls) == 1


def test_report_is_one_csv(spark, tmp_path):
    reports.write_report(spark.range(3).repartition(3), str(tmp_path / "r"))
    assert len(list((tmp_path / "r").glob("part-*"))) == 1


def test_staged_goes_to_the_named_folder(spark, sf_dir):
    rows = staged(X.truth(spark, sf_dir))
    assert all(shared_folder(spark) in f for f in rows.inputFiles())
    assert sorted(rows.collect()) == sorted(X.truth(spark, sf_dir).collect())
