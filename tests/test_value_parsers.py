"""Dimensions and names as recorded, against own cases."""

import pytest
from pyspark.sql import functions as F

from curiospark.functions import dimensions, persons

DIMENSIONS = {
    "12 x 7cm": [("height", 12.0, "cm", None, None), ("width", 7.0, "cm", None, None)],
    "H 3½ in": [("height", 3.5, "in", None, None)],
    "18.5/8 in wide": [("width", 18.625, "in", None, None)],
    "5 ft 4 in": [(None, 64.0, "in", None, None)],
    "2 lb 3 oz": [("weight", 35.0, "oz", None, None)],
    "10-12 mm thick": [("thickness", 10.0, "mm", "minimum", None), ("thickness", 12.0, "mm", "maximum", None)],
    "1,250 kg": [("weight", 1250.0, "kg", None, None)],
    "29,4 cm": [(None, 29.4, "cm", None, None)],
    "lid: dia 4 cm?": [("diameter", 4.0, "cm", "uncertain", "lid")],
    "base (mm): 40": [(None, 40.0, "mm", None, "base")],
    "40 mm (approx)": [(None, 40.0, "mm", "approx", None)],
    "15 cm (6 in)": [(None, 15.0, "cm", None, None), (None, 6.0, "in", "parenthetical", None)],
    "9 by 4 in": [("height", 9.0, "in", None, None), ("width", 4.0, "in", None, None)],
    "30 oz capacity": [("weight", 30.0, "oz", None, None)],
    "height 9 cm width 4 cm": [("height", 9.0, "cm", None, None), ("width", 4.0, "cm", None, None)],
    "<2 g": [("weight", 2.0, "g", "maximum", None)],
    "cm 21": [(None, 21.0, "cm", None, None)],
    "12-10 mm": None, "3/0 in": None, "large": None, "": None, None: None,
}


def test_dimensions(spark):
    rows = spark.createDataFrame([(v,) for v in DIMENSIONS], "raw string").select("raw", dimensions.dimensions(F.col("raw")).alias("d")).collect()
    got = {r.raw: r.d and [(m.dimension_type, m.dimension_value, m.dimension_measurement_unit, m.dimension_value_qualifier, m.dimension_measured_part) for m in r.d.measurements] for r in rows}
    assert got == DIMENSIONS


def test_dimension_residue_and_primes():
    found = dimensions.read("frame: 3 x 2 in; 4 hinges")
    assert (found["status"], found["residue"], found["measurements"][0]["type_ambiguous"]) == ("partial", ["4 hinges"], True)
    assert [dimensions.read("3'", unit)["measurements"][0]["dimension_measurement_unit"] for unit in ("ft", "in")] == ["ft", "in"]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("Holt, Ada Mary", ("person", "inverted", None, None, "Ada", "Mary", "Holt", None)),
        ("Holt, Rev J.", ("person", "inverted", None, "Rev", "J.", None, "Holt", None)),
        ("Berg, Piet van den", ("person", "inverted", None, None, "Piet", None, "van den Berg", None)),
        ("Holt, Ada, Mrs, MBE", ("person", "inverted_tail", None, "Mrs", "Ada", None, "Holt", "MBE")),
        ("Holt, Ada, painter", ("person", "plain", "no_convention", None, None, None, None, None)),
        ("Holt/A.B.<B.Sc", ("person", "slashed", None, None, "A.B.", None, "Holt", "B.Sc")),
        ("Holt / Reed", ("person", "slashed", "slash_convention", None, None, None, None, None)),
        ("Holt, A. < by letter of 1901", ("person", "slashed", "slash_convention", None, None, None, None, None)),
        ("Holt & Reed", ("organisation", "and_organisation", None, None, None, None, None, None)),
        ("Ada Holt and Ben Reed", ("person", "plain", "no_convention", None, None, None, None, None)),
        ("", ("person", "plain", "no_convention", None, None, None, None, None)),
    ],
)
def test_persons(raw, want):
    found = persons.read(raw)
    assert tuple(found[k] for k in ("entity", "convention", "reason", "prefix", "given", "middle", "surname", "suffix")) == want


def test_person_columns(spark):
    rows = spark.createDataFrame([("Holt, Ada",), (None,), ("Minton",)], "raw string").select("raw", persons.person(F.col("raw"), True).alias("p")).collect()
    assert {r.raw: r.p and (r.p.entity, r.p.display) for r in rows} == {"Holt, Ada": ("person", "Ada Holt"), None: None, "Minton": ("organisation", "Minton")}
