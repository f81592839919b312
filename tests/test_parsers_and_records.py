import json

from pyspark.sql import functions as F

from curiospark.functions import parsers
from curiospark.sources import records


def parsed(spark, parser, values):
    rows = spark.createDataFrame([(v,) for v in values], "raw string").select("raw", parser(F.col("raw")).alias("p")).collect()
    return {r.raw: r.p for r in rows}


def test_money(spark):
    want = {
        "£1,250.5": ("gbp_decimal", 125050, False, None), "[8/3]": ("gbp_lsd", 99, True, None), "£2-5-11 for two": ("gbp_lsd", 551, False, "for two"),
        "30/-": ("gbp_lsd", 360, False, None), "4s 2d": ("gbp_lsd", 50, False, None), "3d": ("gbp_lsd", 3, False, None), "1.5 gns": ("gbp_guinea", 378, False, None),
        "8 shillings": ("gbp_lsd", 96, False, None), "£1/20/0": None, "3/12": None, "2/- and 1/- for 9": None, "cheap": None, "": None, None: None,
    }
    got = parsed(spark, parsers.money, want)
    assert {k: v and tuple(v) for k, v in got.items()} == want


def test_counts(spark):
    want = {
        "7": [(7, None, None, None, None)], "About 9 Loose beads.": [(9, "approx", "loose beads", None, None)], "nineteen": [(19, None, None, None, None)],
        "2 + 3 to 5 lids": [(2, None, None, None, None), (None, None, "lids", 3, 5)], "5-3": None, "six hundred": None, "4 +": None, "": None, None: None,
    }
    got = parsed(spark, parsers.counts, want)
    assert {k: v and [tuple(p) for p in v] for k, v in got.items()} == want


def test_certainty(spark):
    want = {
        "elm (??)": ("elm", "(??)"), "[ gold ]": ("gold", "[]"), "Perhaps jet?": ("jet", "?+Perhaps"), "jet; presumed": ("jet", "presumed"), "c. 1720": ("1720", "c."),
        "C. Jones": None, "???": None, "www.a.org?": None, "elm": None, "a [b] c": None, "elm?" + " " * 90: None, "": None, None: None,
    }
    got = parsed(spark, parsers.certainty, want)
    assert {k: v and tuple(v) for k, v in got.items()} == want


def test_records(spark, tmp_path):
    def unit(label, *units, **more):
        return {"label": label, "value": label.upper(), "units": list(units)} | more

    deep = unit("a", unit("b", unit("c", unit("d", unit("e")))), unit("b"))
    lines = [
        {"@admin": {"uuid": "u1", "processed": 1, "data_source": {"name": "North"}}, "@document": {"units": [unit("old")]}},
        {"@admin": {"uuid": "u1", "processed": 2, "data_source": {"name": "North"}}, "@document": {"units": [deep, unit("z")]}},
        {"@admin": {"uuid": "u2", "processed": 1, "data_source": {"name": "South"}}, "@document": {"units": []}},
        {"@admin": {"uuid": "u3", "processed": 1}},
    ]
    (tmp_path / "r.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n{broken\n")
    kept = records.newest(records.read_records(spark, str(tmp_path / "r.jsonl")), "record_id", "processed", "ordinal")
    assert kept.count() == 3
    got = {(r.node_id, r.parent_id, r.depth, r.label, r.value) for r in records.flatten(kept).collect()}
    assert got == {
        ("u1/0", None, 0, "a", "A"), ("u1/0/0", "u1/0", 1, "b", "B"), ("u1/0/1", "u1/0", 1, "b", "B"), ("u1/0/0/0", "u1/0/0", 2, "c", "C"),
        ("u1/0/0/0/0", "u1/0/0/0", 3, "d", "D"), ("u1/1", None, 0, "z", "Z"),
    }
    assert [json.loads(r.deeper)[0]["label"] for r in records.flatten(kept).where("depth = 3").collect()] == ["e"]


def test_triples(spark, tmp_path):
    (tmp_path / "t.nt").write_text('<http://a> <http://p> "x . y"@en .\n# note\n<http://a> <http://q> <http://b> .\n')
    got = {tuple(r) for r in records.read_triples(spark, str(tmp_path / "t.nt")).collect()}
    assert got == {("http://a", "http://p", '"x . y"@en'), ("http://a", "http://q", "<http://b>")}


def test_streams(spark, tmp_path):
    from curiospark.streaming import events

    source, out, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    rows = spark.createDataFrame([("2024-01-01 00:10:00", "x", 1.0), ("2024-01-01 00:50:00", "x", 2.0), ("2024-01-01 01:10:00", "y", 4.0)], "at string, event_type string, value double")
    rows = rows.select(F.to_timestamp("at").alias("ts"), "event_type", "value")
    rows.write.parquet(source)
    stream = lambda: spark.readStream.schema(rows.schema).parquet(source)
    events.ingest_available(spark, stream(), out, marks)
    events.ingest_available(spark, stream(), out, marks)
    assert spark.read.parquet(out).count() == 3
    query = events.windowed_counts(stream()).writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r.event_type, r.n, r.total) for r in spark.table("counted").collect()) == [("x", 2, 3.0), ("y", 1, 4.0)]
