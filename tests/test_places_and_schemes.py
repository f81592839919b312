from pyspark.sql import functions as F

from curiospark.operators import places, schemes


def test_spellings_go_from_close_to_far(spark):
    rows = spark.createDataFrame([("st. ives",), ("st ives",), ("ives",), ("",), (None,)], "norm string").select(places.spellings(F.col("norm")).alias("v")).collect()
    assert [r.v for r in rows] == [["st ives", "saint ives"], ["saint ives"], [], [], []]


def test_places_that_cannot_be_read(spark):
    rows = spark.createDataFrame([("a, , b", "A, , B"), ("a, b", "A; B"), ("a,b,c,d,e,f,g", "A,B,C,D,E,F,G"), ("(x)", "(X)"), ("a > b", "A > B"), ("a (b)", "A (B)"), (None, None)], "norm string, atom string")
    read, unread = places.orientations(rows)
    assert sorted(r.norm for r in unread.collect()) == ["a, , b", "a, b", "a,b,c,d,e,f,g"]
    assert sorted((r.orientation, r.head, r.context, r.qualifier) for r in read.collect()) == [("first", "a", ["b"], "B"), ("last", "b", ["a"], "A"), ("paren", "a", ["b"], "B")]


def test_years_of_slots_and_of_two_digits(spark):
    rows = spark.createDataFrame([("AB1954.3", 1, "54", 1990), ("1954", 1, "95", 1990), (None, 0, "1850", None), ("195", 0, "07", None), ("x", None, None, 1990)], "value string, slot int, digits string, top int")
    got = rows.select(schemes.year_at(F.col("value"), F.col("slot")).alias("y"), schemes.complete_year(F.col("digits"), F.col("top")).alias("c")).collect()
    assert [(r.y, r.c) for r in got] == [(1954, "1954"), (None, "1895"), (None, "1850"), (None, None), (None, None)]


def test_without_values(spark):
    none = spark.createDataFrame([], "record_id long, data_source string, value string")
    found = schemes.year_slots(none, "data_source")
    assert found.count() == 0 and schemes.structure(schemes.encoded_years(none, found, "data_source")).count() == 0
