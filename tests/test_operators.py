"""Saves, checks, typing, catalogue, profiles and streams."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakelens.lake import Lake
from lakelens.operators.catalog import (
    CATALOG_SCHEMA,
    append_entries,
    latest,
    load_catalog,
    normalize_format,
    read_catalog_csv,
    search,
    upsert,
    write_catalog_csv,
)
from lakelens.operators.csv_check import bad_records, check_csv_files
from lakelens.operators.json_rows import infer_json_types, json_rows_to_table, json_schema
from lakelens.operators.paths import normalize_path, normalized_path
from lakelens.operators.payload import check_payloads
from lakelens.operators.profile import keyword_compare, profile_nulls
from lakelens.streaming.streams import write_catalog, write_filtered


def json_frame(spark, *rows):
    return spark.createDataFrame([(i, row) for i, row in enumerate(rows)], "id long, j string").repartition(3)


def test_json_rows(spark):
    rows = json_frame(
        spark,
        '{"tank":40,"fluid":"brine","litres":7,"sealed":false}',
        '{"litres":0.25,"tank":41,"sealed":true,"fluid":null}',
        '{"tank":42}',
    )
    table = json_rows_to_table(rows, "j", "id")
    assert table.schema.simpleString() == "struct<tank:bigint,fluid:string,litres:double,sealed:boolean>"
    assert [tuple(r) for r in table.orderBy("tank").collect()] == [
        (40, "brine", 7.0, False), (41, None, 0.25, True), (42, None, None, None),
    ]


def test_json_types(spark):
    rows = json_frame(
        spark,
        '{"z":1,"b":10.0,"c":12345678901234567890,"d":true,"e":null,"f":"x","g":9223372036854775807}',
        '{"z":2,"b":3,"c":1,"d":"yes","e":null,"f":{"k":[1]},"g":-9223372036854775808,"late":1e2}',
        "{}",
    )
    types = {r["column"]: r["type"] for r in infer_json_types(rows, "j").collect()}
    assert types == {
        "z": "bigint", "b": "double", "c": "double", "d": "string", "e": "string", "f": "string", "g": "bigint",
        "late": "double",
    }
    assert json_schema(rows, "j", "id").names == ["z", "b", "c", "d", "e", "f", "g", "late"]
    table = json_rows_to_table(rows, "j", "id").orderBy("z").collect()
    assert table[1].d == "true" and table[2].d == "yes" and table[2].f == '{"k":[1]}' and table[0].z is None
    assert table[1].c == 12345678901234567890.0


def test_json_errors(spark):
    empty = spark.createDataFrame([], "j string")
    with pytest.raises(ValueError, match="At least one row"):
        json_rows_to_table(empty, "j")
    for bad in ("not json", "[1,2]", '"text"'):
        with pytest.raises(ValueError, match="1 rows are not"):
            json_rows_to_table(json_frame(spark, '{"a":1}', bad), "j")
    for bad in ("{}", '{" ":1}'):
        with pytest.raises(ValueError, match="column"):
            json_rows_to_table(json_frame(spark, bad), "j")


def test_csv_check(spark, lake_file):
    lake_file("good.csv", 'a,b\n1,"x\ny"\n2,"p,q"\n', "check")
    lake_file("bad.csv", "a,b\n1,2\n\n1,2,3\n4\n5,6\n", "check")
    lake_file("multi.csv", 'a,b\n1,"x\ny"\n3,"p\nq",7\n', "check")
    folder = lake_file("fine.csv", "a\n1\n", "check").rsplit("/", 1)[0]
    found = {r["file"].rsplit("/", 1)[1]: tuple(r)[1:] for r in check_csv_files(spark, folder).collect()}
    assert found == {"bad.csv": (3, 3, 2, 2), "multi.csv": (3, 3, 2, 1)}


def test_csv_check_over_splits(spark, lake_file):
    lines = [f"{i},{i}" for i in range(3000)]
    lines[2500] = "1,2,3"
    lines[2900] = "x"
    path = lake_file("big.csv", "\n".join(lines))
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        assert tuple(check_csv_files(spark, path).first())[1:] == (2501, 3, 2, 2)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)


def test_bad_records(spark):
    rows = [(1, "a,b"), (2, '"x,1",y'), (3, "1,2,3"), (4, ""), (5, "z"), (6, '"q""r,",s')]
    df = spark.createDataFrame(rows, "id int, line string")
    assert [tuple(r) for r in bad_records(df, "line", 2).orderBy("id").collect()] == [(3, "1,2,3", 3, 2), (5, "z", 1, 2)]


def test_payloads(spark):
    rows = [(1, "cGxhaW4gdGV4dA=="), (2, "#!?"), (3, "JVBERi0xLjQgYWJj"), (4, "JVBERi0"), (5, "JVBE\nRi0x LjQg YWJj")]
    df = spark.createDataFrame(rows, "id int, b string")
    found = [tuple(r) for r in check_payloads(df, "b").select("id", "valid", "reason").orderBy("id").collect()]
    assert found == [
        (1, False, "not a pdf"), (2, False, "not base64"), (3, True, None), (4, False, "not base64"), (5, True, None),
    ]


def test_paths(spark):
    good = {"tide\\north///low.csv": "tide/north/low.csv", "//log.md": "log.md", " in / out.txt ": "in/out.txt"}
    bad = ["..", "tide/../../low.csv", "//", "tide/./low.csv", " "]
    for path, expected in good.items():
        assert normalize_path(path) == expected
    for path in bad:
        with pytest.raises(ValueError):
            normalize_path(path)
    df = spark.createDataFrame([(p,) for p in [*good, *bad]], "p string")
    assert [r[0] for r in df.select(normalized_path(F.col("p"))).collect()] == [*good.values()] + [None] * len(bad)


def entry(path, size=1, minute=0, description=None):
    name = path.rsplit("/", 1)[-1]
    return (path, name, name.rsplit(".", 1)[-1], size, dt.datetime(2024, 1, 1, 0, minute), description)


def test_catalog_search(spark):
    entries = spark.createDataFrame([entry("tide/harbour.csv"), entry("old/harbour.parquet"), entry("log.md")], CATALOG_SCHEMA)

    def names(*args):
        return sorted(r["path"] for r in search(entries, *args).collect())

    assert names("HARB") == ["old/harbour.parquet", "tide/harbour.csv"]
    assert names("harbour", ".PARQUET") == ["old/harbour.parquet"]
    assert names(None, "markdown") == ["log.md"]
    assert names("quay", None) == []
    assert names(" ", "") == ["log.md", "old/harbour.parquet", "tide/harbour.csv"]
    assert [normalize_format(f) for f in (" ..Text", "PDF", None, ".")] == ["txt", "pdf", None, None]


def test_catalog_upsert(spark, tmp_path):
    old = spark.createDataFrame([entry("in/low.csv", 30, 5), entry("in/high.md", 70, 1)], CATALOG_SCHEMA)
    new = spark.createDataFrame([entry("IN/Low.CSV", 12, 2, "ebb, flood")], CATALOG_SCHEMA)
    merged = {r["path"]: (r["sizeBytes"], r["description"]) for r in upsert(old, new).collect()}
    assert merged == {"in/high.md": (70, None), "IN/Low.CSV": (12, "ebb, flood")}
    assert {r["path"] for r in latest(old.unionAll(new)).collect()} == {"in/low.csv", "in/high.md"}
    path = str(tmp_path / "index.csv")
    write_catalog_csv(upsert(old, new), path)
    back = read_catalog_csv(spark, path)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, upsert(old, new).collect()), key=str)


def test_catalog_parse(spark, lake_file):
    path = lake_file(
        "i.csv",
        "path,name,format,sizeBytes,savedAt,description\n"
        'a/x.csv,x.csv,csv,12,2024-01-31T10:00:00.1234567+02:00,"one, two"\n'
        "b/y.md,y.md,md,big,never,\n",
    )
    rows = {r["name"]: r for r in read_catalog_csv(spark, path).collect()}
    assert rows["x.csv"].sizeBytes == 12 and rows["x.csv"].savedAt == dt.datetime(2024, 1, 31, 8, 0, 0, 123456)
    assert rows["y.md"].sizeBytes == 0 and rows["y.md"].savedAt is None
    assert load_catalog(spark, path + ".missing").count() == 0


def test_lake_round_trips(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert lake.search_file().files.count() == 0
    table = spark.createDataFrame([(1, 'a "q", b', " x "), (2, None, ""), (3, "two\nlines", "z")], "id int, t string, u string")
    saved = lake.save_csv("out//t.CSV", table, description="first, with comma").first()
    assert (saved.path, saved.name, saved.format, saved.sizeBytes > 0) == ("out/t.CSV", "t.CSV", "csv", True)
    rows = sorted(tuple(r) for r in lake.read_csv("out/t.CSV").rows)
    assert rows == [("1", 'a "q", b', " x "), ("2", "", ""), ("3", "two\nlines", "z")]
    with pytest.raises(FileExistsError):
        lake.save_csv("out/t.CSV", table)
    lake.save_csv("out/t.CSV", table.limit(1), overwrite=True)
    assert len(lake.read_csv("out/t.CSV").rows) == 1
    assert lake.catalog().count() == 1
    lake.save_text("notes/a.txt", "one\ntwo\n\nthree")
    lake.save_markdown("notes/a.md", spark.createDataFrame([("# T",), ("body",)], "value string"))
    assert [r[0] for r in lake.read_text("notes/a.txt").rows][:4] == ["one", "two", "", "three"]
    jsons = json_frame(spark, '{"k":1,"v":"x"}', '{"k":2}')
    lake.save_parquet("t.parquet", jsons, json_column="j")
    found = lake.search_file("T.PARQUET")
    assert found.content.total_rows == 2 and set(found.content.columns) == {"k", "v"}
    assert lake.search_file(format="markdown").content.rows[0][0] in ("# T", "body")
    many = lake.search_file("a.")
    assert many.content is None and many.files.count() == 2
    assert [r["name"] for r in lake.get_parquet_schema("t.parquet").collect()] == ["k", "v"]
    assert lake.get_file_info("t.parquet").count() >= 1
    assert "notes" in {r["name"] for r in lake.list_directory().collect()}


def test_save_rules(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    rows = spark.range(1).select(F.lit("x").alias("value"))
    for call in (
        lambda: lake.save_text("a.md", rows),
        lambda: lake.save_text("../a.txt", rows),
        lambda: lake.save_parquet("Saved-Files-Index.PARQUET", rows),
        lambda: lake.save_csv("a.csv", "a,b\n1,2,3"),
        lambda: lake.save_csv("a.csv", "  "),
        lambda: lake.save_csv("a.csv", rows, delimiter=""),
    ):
        with pytest.raises(ValueError):
            call()
    lake.save_csv("b.csv", 'a,b\n1,"x\ny"')
    assert [tuple(r) for r in lake.read_csv("b.csv").rows] == [("1", "x\ny")]
    assert lake.catalog().first().format == "csv"


def test_profile(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, "", None), (3, None, 10.0)], "id int, t string, d double")
    rows = {r["column"]: r for r in profile_nulls(df).collect()}
    assert tuple(rows["t"])[:6] == ("t", 3, 2, 0.666667, "", "a")
    assert tuple(rows["d"])[:6] == ("d", 3, 1, 0.333333, "2", "10")
    assert rows["id"].approx_distinct == 3


def test_keyword_compare(spark):
    df = spark.createDataFrame(
        [("Red paint", "n", 2023, 5), ("RED paint", "n", 2024, 7), ("blue", "n", 2024, 1), ("red", "s", 2024, 2)],
        "t string, region string, year int, price int",
    )
    rows = keyword_compare(df, "t", "red", "region", "year", "price", [2023, 2024]).orderBy("region").collect()
    assert [tuple(r) for r in rows] == [("n", 5, 7), ("s", None, 2)]


def test_streams(spark, tmp_path):
    source = str(tmp_path / "in")
    df = spark.createDataFrame([(i, f"k{i}") for i in range(20)], "id int, t string")
    df.write.parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    target = str(tmp_path / "out")
    query = write_filtered(stream, [("id", "gte", "15"), ("t", "ne", "K17")], target, str(tmp_path / "c1"))
    query.awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == [15, 16, 18, 19]
    log, index = str(tmp_path / "log"), str(tmp_path / "index")
    for part in ([entry("a.csv", 1, 1), entry("b.csv", 2, 1)], [entry("A.CSV", 7, 2)]):
        spark.createDataFrame(part, CATALOG_SCHEMA).write.mode("append").parquet(log)
        entries = spark.readStream.schema(CATALOG_SCHEMA).parquet(log)
        write_catalog(entries, index, str(tmp_path / "c2")).awaitTermination()
    assert {r["path"]: r["sizeBytes"] for r in load_catalog(spark, index).collect()} == {"A.CSV": 7, "b.csv": 2}


def test_later_append_wins(spark, tmp_path):
    index = str(tmp_path / "log")
    append_entries(spark.createDataFrame([entry("in/low.csv", 1, 30)], CATALOG_SCHEMA), index)
    append_entries(spark.createDataFrame([entry("IN/low.csv", 2, 5)], CATALOG_SCHEMA), index)
    assert [(r["path"], r["sizeBytes"]) for r in load_catalog(spark, index).collect()] == [("IN/low.csv", 2)]


def test_columns_alike_but_for_case(spark, tmp_path):
    rows = json_frame(spark, '{"tank":1,"Tank":2}')
    with pytest.raises(ValueError, match="tank"):
        Lake(spark, str(tmp_path)).save_parquet("t.parquet", rows, json_column="j")


def test_raw_json_values(spark):
    """Values other than strings in text columns stay as they are written, blanks, escapes and exponents included."""
    rows = [
        '{"a": [1, 2], "b": 1e2, "c": "x\\u0041", "d": {"k" : "}\\"", "z":[ {"q":1.0} ]}, "n": 5}',
        '  {"b":"t,{", "a" : null, "c":"q", "d":true,"n":6 , "e\\u0061":{"x" :  1}}',
        '{"a":"s","b": -0.50 , "c":null,"n":7, "ea": "\\"v"}',
        '{"n":1}',
    ]
    df = spark.createDataFrame([(row,) for row in rows], "j string").coalesce(1)
    assert [row.asDict() for row in json_rows_to_table(df, "j").collect()] == [
        {"a": "[1, 2]", "b": "1e2", "c": "xA", "d": '{"k" : "}\\"", "z":[ {"q":1.0} ]}', "n": 5, "ea": None},
        {"a": None, "b": "t,{", "c": "q", "d": "true", "n": 6, "ea": '{"x" :  1}'},
        {"a": "s", "b": "-0.50", "c": None, "d": None, "n": 7, "ea": '"v'},
        {"a": None, "b": None, "c": None, "d": None, "n": 1, "ea": None},
    ]
