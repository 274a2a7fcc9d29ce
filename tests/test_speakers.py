import pytest
from pyspark.sql import functions as F

from sparkseg.functions.speakers import alias_keys, label_key, resolve_speakers, speaker_name, speaker_number

NUMBERED = ["SPEAKER_07", "SPEAKER-07", "SPEAKER_007", "Speaker 7", "speaker_7", "speaker07", "Speaker #7", "SPK07", "spk-7", "Spkr. 7", "S7", "[s7]", " SPEAKER_07 ", "(S7)", "<speaker_7>", "7", "Speaker 7 (on mic)"]


@pytest.mark.parametrize("label", NUMBERED)
def test_numbered_labels(spark, label):
    df = spark.createDataFrame([(label,)], "l string")
    assert df.select(speaker_name(speaker_number("l"))).first()[0] == "SPEAKER_07"


def test_labels_without_number(spark):
    df = spark.createDataFrame([(x,) for x in (None, "", " ", "?", "UNKNOWN", "Sasha 7b", "7 of 9")], "l string")
    assert [r[0] for r in df.select(speaker_number("l")).collect()] == [None] * 7
    assert df.sparkSession.range(1).select(speaker_name(F.lit(123))).first()[0] == "SPEAKER_123"


def test_aliases_within_their_recording(spark):
    alias = spark.createDataFrame([("r", "SPEAKER_01", "Ann Lee"), ("r", "SPEAKER_01", "Ann Lee"), ("r", "SPEAKER_01", "Ann"), ("q", "SPEAKER_02", "Ann"), ("r", "SPEAKER_05", None), (None, "SPEAKER_06", "Bo"), ("r", "nobody", "Cy")], "rec_id string, speaker string, alias string")
    assert alias_keys(alias).count() == 3
    rows = [(1, "r", " ANN  lee "), (2, "r", "Ann (on mic)"), (3, "q", "ann"), (4, "q", "Ann Lee"), (5, None, "Ann"), (6, "r", "S1"), (7, "r", None), (8, "r", "?")]
    df = spark.createDataFrame(rows, "id int, rec_id string, speaker string")
    found = {r.id: r.who for r in resolve_speakers(df, alias, "speaker", "who").collect()}
    assert found == {1: "SPEAKER_01", 2: "SPEAKER_01", 3: "SPEAKER_02", 4: None, 5: None, 6: "SPEAKER_01", 7: None, 8: None}


def test_empty_tables(spark):
    df = spark.createDataFrame([], "id int, rec_id string, speaker string")
    alias = spark.createDataFrame([], "rec_id string, speaker string, alias string")
    assert resolve_speakers(df, alias, "speaker", "who").columns == ["id", "rec_id", "speaker", "who"]
    assert resolve_speakers(df, alias, "speaker", "who").count() == 0
    assert spark.range(1).select(label_key(F.lit("A  b (x)"))).first()[0] == "a b"
