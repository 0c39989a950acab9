"""Values as people read them: the texts that a reader of the recorder's data expects."""

import pytest
from pyspark.sql import functions as F

from tracelake.functions import shown


def one(spark, f, values, kind):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"v {kind}").select(f(F.col("v"))).collect()]


def test_durations(spark):
    cases = {0: "0ms", 850: "850ms", 1000: "1.0s", 1150: "1.1s", 1250: "1.3s", 12_340: "12.3s", 59_949: "59.9s", 59_999: "60.0s", 60_000: "1m 00s", 245_000: "4m 05s", 3_599_499: "59m 59s", 3_599_500: "1h 00m", 3_725_000: "1h 02m"}
    assert one(spark, shown.duration, cases, "long") == list(cases.values())


def test_sizes(spark):
    cases = {512: "512 B", 999_999: "999999 B", 1_500_000: "1.5 MB", 1_050_000: "1.1 MB", 1_150_000: "1.1 MB", 2_340_000_000: "2.34 GB", 5_000_000_000_000: "5000.00 GB"}
    assert one(spark, shown.size, cases, "long") == list(cases.values())


def test_fixed_rounds_the_exact_binary_value(spark):
    from decimal import ROUND_HALF_UP, Decimal

    values = [k / 1000 for k in range(0, 70_000, 7)] + [1.005, 8.345, 1023.995, 1024.005, 99_999.125]
    for places in (1, 2):
        want = [str(Decimal(x).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)) for x in values]
        assert one(spark, lambda v: shown.fixed(v, places), values, "double") == want


@pytest.mark.parametrize("value, text", [
    (None, "nil"), ("null", "nil"), ("5", "5"), ("5.0", "5"), ("0.1", "0.1"), ("0.00001", "0.00001"), ("0.0000001", "1e-7"), ("-12.5e25", "-1.25e+26"), ("true", "true"), ("plain text", '"plain text"'), ('"5"', '"5"'),
    ('["a",null,5]', '("a", nil, 5)'), ('{"1":"a","3":5,"n":3}', '("a", nil, 5)'), ('{"n":0}', "()"), ("{}", "{}"), ("[]", "()"), ('{"id":5,"x":[1,{"y":"z"}]}', '{ id: 5, x: (1, { y: "z" }) }'), ('{"b":1,"10":2,"9":3}', "{ 9: 3, 10: 2, b: 1 }"),
])
def test_previews(spark, value, text):
    assert one(spark, shown.preview, [value], "string") == [text]


def test_arguments(spark):
    long = "x" * 61
    cases = {None: "", '{"n":0}': "", '{"1":"a","2":null,"3":true,"n":3}': '"a", nil, true', f'{{"1":"{long}","n":1}}': '"' + "x" * 57 + '..."', '{"1":"' + "y" * 60 + '","2":"' + "z" * 30 + '","n":2}': ('"' + "y" * 60 + '", "' + "z" * 30 + '"')[:77] + "...", '{"a":1}': '{"a":1}'}
    assert one(spark, shown.arguments, cases, "string") == list(cases.values())
