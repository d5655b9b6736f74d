import json

import pytest
from pyspark.sql import functions as F

from smogline.functions import jsonpath

DEVICE = '{"name":"Probe 7","age":45,"sides":["north","south","roof"],"height":1.5,"none":null}'


def one(spark, column, text=DEVICE):
    return spark.createDataFrame([(text,)], "t STRING").select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("column", "value"),
    [
        (lambda: jsonpath.get("t", "$.name"), "Probe 7"),
        (lambda: jsonpath.get("t", "$.sides[1]"), "south"),
        (lambda: jsonpath.get("t", "$.sides[9]"), None),
        (lambda: jsonpath.get("t", "$.name[0]"), None),
        (lambda: jsonpath.get("t", "$.none"), None),
        (lambda: jsonpath.get_int("t", "$.age"), 45),
        (lambda: jsonpath.get_int("t", "$.height"), None),
        (lambda: jsonpath.get_int("t", "$.name"), None),
        (lambda: jsonpath.get_double("t", "$.height"), 1.5),
        (lambda: jsonpath.get_double("t", "$.age"), 45.0),
        (lambda: jsonpath.get_double("t", "$.name"), None),
        (lambda: jsonpath.length("t"), 5),
        (lambda: jsonpath.length(jsonpath.get("t", "$.sides")), 3),
        (lambda: jsonpath.length(jsonpath.get("t", "$.age")), None),
    ],
)
def test_paths(spark, column, value):
    assert one(spark, column()) == value


def test_number_in_quotes_is_no_number(spark):
    assert one(spark, jsonpath.get_int("t", "$.a"), '{"a":"45"}') is None
    assert one(spark, jsonpath.get_int("t", "$.a"), '{"a":99999999999}') is None


def test_strict_raises(spark):
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        one(spark, jsonpath.get("t", "$.name", "int", strict=True))


def test_bad_text_is_null(spark):
    assert one(spark, jsonpath.get("t", "$.a"), "{bad") is None
    assert one(spark, jsonpath.length("t"), "{bad") is None


def test_items(spark):
    texts = [(1, '["a",{"b":2},3]'), (2, '{"k":[1],"j":null}'), (3, "{bad"), (4, "[]")]
    items = jsonpath.items(spark.createDataFrame(texts, "id INT, t STRING"), "t", ["id"])
    found = sorted((row.id, row.pos, row.key, row.item) for row in items.filter("pos IS NOT NULL").collect())
    assert found == [
        (1, 0, None, '"a"'),
        (1, 1, None, '{"b":2}'),
        (1, 2, None, "3"),
        (2, 0, "j", "null"),
        (2, 1, "k", "[1]"),
    ]


def test_dumps_escapes(spark):
    text = one(spark, jsonpath.dumps(F.struct(F.lit('say "hi"\\\n').alias("a"), F.array(F.lit(1), F.lit(2)).alias("b"))))
    assert json.loads(text) == {"a": 'say "hi"\\\n', "b": [1, 2]}
