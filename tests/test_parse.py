import sys
from datetime import datetime
from random import Random

import pytest
from pyspark.sql import functions as F
from records import at, tuples

from roadpulse.operators.parse import (
    WHITE_SPACE,
    ingest_report,
    parse_telemetry,
    split_fields,
    split_rejects,
    with_shard,
)
from roadpulse.schema import TELEMETRY_SCHEMA

LINES = [
    "d1,P1,22.1,113.2,60,90,siteA,2017-01-01 08:00:10,,,1,,12,,,,,,,",
    "d2,粤A,,,,,,2017-01-01 08:00:11",
    "   ",
    "d3,P3,22.5d,113,60,90,s,2017-01-01 08:00:12",
    "d4,P4,22.5,113,6x,90,s,2017-01-01 08:00:13",
    "d5,P5,22.5,113,60,90,s,not-a-time",
    "d6,P6,22.5,113,60,90,s,2017-01-01 08:00:14,1,0,2,0,5,1,1,7,0,0,1,3,EXTRA,MORE",
    "d7",
]


def lines(spark, *values):
    name = "detail_record_2017_01_02_00_00_00.csv"
    return spark.createDataFrame([(v, name) for v in values], "value string, file_name string")


def reasons(spark, line):
    return parse_telemetry(lines(spark, line)).first()["reject_reasons"]


def test_good_lines(spark):
    good, _ = split_rejects(parse_telemetry(lines(spark, *LINES)))
    no, yes = False, True
    assert sorted(tuples(good.drop("file_name"))) == [
        ("d1", "P1", 22.1, 113.2, 60, 90, "siteA", at("2017-01-01 08:00:10"))
        + (no, no, yes, no, 12, no, no, 0, no, no, no, None),
        ("d2", "粤A", None, None, None, None, None, at("2017-01-01 08:00:11"))
        + (no, no, no, no, 0, no, no, 0, no, no, no, None),
        ("d6", "P6", 22.5, 113.0, 60, 90, "s", at("2017-01-01 08:00:14"))
        + (yes, no, yes, no, 5, yes, yes, 7, no, no, yes, 3),
        ("d7", None, None, None, None, None, None, None)
        + (no, no, no, no, 0, no, no, 0, no, no, no, None),
    ]


def test_record_types(spark):
    parsed = parse_telemetry(lines(spark, *LINES)).select(*TELEMETRY_SCHEMA.fieldNames())
    assert [f.dataType for f in parsed.schema] == [f.dataType for f in TELEMETRY_SCHEMA]


def test_rejects_and_report(spark):
    parsed = parse_telemetry(lines(spark, *LINES))
    _, bad = split_rejects(parsed)
    assert sorted((r["line"][:2], r["reject_reasons"]) for r in bad.collect()) == [
        ("d3", ["latitude"]),
        ("d4", ["speed"]),
        ("d5", ["record_time"]),
    ]
    assert tuples(ingest_report(parsed)) == [(7, 4, 3)]


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("d,p,nan,inf,1,1", ["latitude", "longitude"]),
        ("d,p, +1.5e2 ,.5,-3, 7 ", []),
        ("d,p,1.,2,60.0", ["speed"]),
        ("d,p,,,99999999999,1_000", ["speed", "direction"]),
        ("d,p,,,,,,2017-02-30 00:00:00", ["record_time"]),
        ("d,p,,,,,,2017", ["record_time"]),
        ("d,p,,,,,,2017-1-2 3:04", []),
        ("d,p,,,,,,2017-01-01 08:00:00+01:00", ["record_time"]),
        ("d,p,,,,,,,x,x", ["isRapidlySpeedup", "isRapidlySlowdown"]),
        ("", None),
    ],
)
def test_reject_rules(spark, line, expected):
    row = parse_telemetry(lines(spark, line)).first()
    assert (row and row["reject_reasons"]) == expected


def test_undecodable_text_is_rejected(spark):
    raw = lines(spark, "x").withColumn("value", F.expr("cast(X'642CFF' AS string)"))
    assert parse_telemetry(raw).first()["reject_reasons"] == ["encoding"]


def test_line_is_stripped_but_inner_fields_keep_blanks(spark):
    rows = split_fields(lines(spark, " 　\t a , b ,  \x1f")).collect()
    assert rows[0]["fields"] == ["a ", " b ", ""]


def test_white_space_is_all_of_unicode():
    assert set(WHITE_SPACE) == {c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()}


def test_empty_driver_and_plate_are_kept(spark):
    row = parse_telemetry(lines(spark, ",,")).first()
    assert (row["driverID"], row["carPlateNumber"]) == ("", "")


def test_shard_routes(spark):
    parsed = parse_telemetry(lines(spark, "d,p,,,,,,2017-02-05 00:00:00"))
    assert with_shard(parsed).first()["shard"] == "2017_01"
    assert with_shard(parsed, route="record_time").first()["shard"] == "2017_02"
    with pytest.raises(ValueError):
        with_shard(parsed, route="size")


TEXTS = ["", "0", "1", "12", "-3", "+4", "6x", "1.5", " 7 ", ".", "1e3", "abc", "2017-01-01 08:00:00"]


def expected(line):
    """What one line should give, told field by field with Python's own conversions."""
    parts = line.strip().split(",")
    values, failed = [], []
    for position, field in enumerate(TELEMETRY_SCHEMA.fields):
        text = parts[position] if position < len(parts) else None
        kind = field.dataType.typeName()
        value = text if kind == "string" else None
        if position > 1 and text == "":
            text = value = None
        if text is not None and kind != "string":
            convert = {"double": float, "timestamp": datetime.fromisoformat}.get(kind, int)
            try:
                value = convert(text)
            except ValueError:
                failed.append(field.name)
        if kind == "boolean":
            value = bool(value)
        if field.name in ("neutralSlideTime", "overspeedTime"):
            value = value or 0
        values.append(value)
    return failed, tuple(values)


def test_random_lines_equal_a_field_by_field_model(spark):
    random = Random(11)
    made = []
    for _ in range(3000):
        fields = [random.choice(TEXTS) if random.random() < 0.2 else "" for _ in range(22)]
        if random.random() < 0.8:
            fields[7] = random.choice(["2017-01-01 08:00:00", "2017-01-01", ""])
        made.append(",".join(fields[: random.randint(1, 22)]))
    made = [m for m in made if m.strip()]
    parsed = parse_telemetry(lines(spark, *made)).collect()
    names = TELEMETRY_SCHEMA.fieldNames()
    got = {row["line"]: (row["reject_reasons"], tuple(row[n] for n in names)) for row in parsed}
    for line in made:
        failed, values = expected(line)
        reasons, stored = got[line.strip()]
        assert reasons == failed
        if not failed:
            assert stored == values
