import gzip

import pytest

from tallyforge.sources.delimited import parse_alias, parse_dimension, parse_facts, read_facts
from tallyforge.sources.fixed_width import parse_fixed_width, read_fixed_width
from tallyforge.sources.survey import SURVEY_SCHEMA, read_csv

RECORD = "0000000000000002000070415004+49617+006217FM-15+037699999V0202301N00461007001CN0100001N9+02351-00121"
NUMBERS = (2000, 7, 4, 15, 49.617, 6.217, 376, 230, 4.6, 700, 10000, -1.2, 23.5)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_fixed_width_record(spark):
    good, rejects = parse_fixed_width(lines(spark, RECORD))
    assert tuple(good.first()) == pytest.approx(NUMBERS)
    assert good.columns[-2:] == ["dewPointTemperature", "airTemperature"]
    assert {t for _, t in good.dtypes} == {"double"}
    assert rejects.count() == 0


def test_fixed_width_missing_is_no_reject(spark):
    missing = RECORD[:87] + "+9999" + RECORD[92:]
    good, rejects = parse_fixed_width(lines(spark, missing))
    assert good.count() == 0 and rejects.count() == 0


def test_fixed_width_rejects(spark):
    bad_year, blank = RECORD[:15] + "20x0" + RECORD[19:], RECORD[:60] + " 23" + RECORD[63:]
    good, rejects = parse_fixed_width(lines(spark, RECORD, RECORD[:97], bad_year, blank, ""))
    assert good.count() == 1
    assert sorted(r.reason for r in rejects.collect()) == ["bad directionAngle", "bad year", "short", "short"]


def test_fixed_width_can_fail(spark):
    good = parse_fixed_width(lines(spark, RECORD, RECORD[:97]), on_error="fail").good
    with pytest.raises(Exception, match="refused line"):
        good.collect()


def test_fixed_width_null_codes(spark):
    good = parse_fixed_width(lines(spark, RECORD), null_codes={"directionAngle": "230"}).good
    assert good.first()["directionAngle"] is None


def test_fixed_width_glob_of_plain_and_gzip(spark, tmp_path):
    (tmp_path / "station-2000").write_text(RECORD + "\n" + RECORD + "\n")
    with gzip.open(tmp_path / "station-2001.gz", "wt") as f:
        f.write(RECORD + "\n")
    (tmp_path / "other").write_text("x\n")
    assert read_fixed_width(spark, str(tmp_path / "station*")).good.count() == 3


def test_dimension_is_lenient(spark):
    given = lines(spark, "1\tA\tB", "5\t   ", "abc\tx", "no tab", "\tx", " 7\ty", "+8\t z ", "")
    good, rejects = parse_dimension(given)
    assert sorted(map(tuple, good.collect())) == [(1, "A\tB"), (5, ""), (8, "z")]
    assert rejects.count() == 5


def test_alias(spark):
    good, rejects = parse_alias(lines(spark, "1\t2", "\t5", "", "3\t", "4", "x\t1", "6\t7\t8"))
    assert sorted(map(tuple, good.collect())) == [(1, 2), (6, 7)]
    assert sorted(r.value for r in rejects.collect()) == ["3\t", "4", "x\t1"]
    with pytest.raises(Exception, match="refused line"):
        parse_alias(lines(spark, "4"), on_error="fail").good.collect()


def test_facts(spark, tmp_path):
    text = ["1 2 3", "1 2 3  ", "1 2", "1  2 3", "1 2 3 4", "a 2 3", "1 2 3.0", "1 2 99999999999", "1 -2 +3"]
    good, rejects = parse_facts(lines(spark, *text))
    assert sorted(map(tuple, good.collect())) == [(1, -2, 3.0), (1, 2, 3.0), (1, 2, 3.0)]
    assert rejects.count() == 6
    path = tmp_path / "facts.txt"
    path.write_text("1 2 3\n")
    assert read_facts(spark, str(path), "fail").good.count() == 1


def test_csv(spark, tmp_path):
    path = tmp_path / "survey.csv"
    path.write_text(",".join(SURVEY_SCHEMA.names) + "\n" + "No,16.6,Yes,No,No,3.0,30.0,No,Female,55-59,White,Yes,Yes,Very good,5.0,Yes,No,Yes\n" + "No,,Yes,No,No,3.0,30.0,No,Female,55-59,White,Yes,Yes,Very good,5.0,Yes,No,Yes\n")
    typed, inferred = read_csv(spark, str(path)), read_csv(spark, str(path), None)
    assert typed.schema == SURVEY_SCHEMA and inferred.schema == SURVEY_SCHEMA
    assert [r["BMI"] for r in typed.collect()] == [16.6, None]
