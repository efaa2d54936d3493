"""Scans, schemas, projections and pages on small hand-written files."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import functions as F

from lakelens.operators.csv_check import check_csv_files
from lakelens.operators.paging import Walk, _within_files, page, page_after, page_flags, page_frame
from lakelens.operators.project import project_existing, project_requested
from lakelens.plans.model import read_folder
from lakelens.sources import xml, xml_split
from lakelens.sources.csv import read_csv
from lakelens.sources.files import list_directory
from lakelens.sources.parquet import parquet_schema, read_parquet
from lakelens.sources.position import FILE, ROW, input_files
from lakelens.sources.text import read_text
from lakelens.sources.xml import read_xml, xml_schema


def values(rows, name):
    return [row[name] for row in rows]


def csv_page(spark, path, **kwargs):
    read = {k: kwargs.pop(k) for k in ("delimiter", "has_header", "multiline") if k in kwargs}
    return page(read_csv(spark, path, position=True, **read), **kwargs)


@pytest.mark.parametrize(
    "content,options,expected,truncated,next_offset",
    [
        ("gauge,site\n7,Oslo\n9,Turku", {"max_rows": 100}, ["7", "9"], False, None),
        ("gauge\n11\n12\n13\n14", {"max_rows": 3}, ["11", "12", "13"], True, 3),
        ("gauge\n11\n12\n13", {"max_rows": 3}, ["11", "12", "13"], False, None),
        ("gauge\n11\n12\n13\n14\n15\n16", {"max_rows": 2, "offset": 3}, ["14", "15"], True, 5),
        ("gauge\n11", {"offset": 4}, [], False, None),
        ("gauge\n11\n12\n13", {"max_rows": -7, "offset": -1}, ["11"], True, 1),
        (
            "gauge,site,level\n1,Oslo,9\n2,Bergen,110\n3,Turku,20.5\n4,Oulu,1e3",
            {"filters": [("level", "gt", "20"), ("site", "ne", "BERGEN")]},
            ["3", "4"],
            False,
            None,
        ),
        (
            "gauge,state\n1,on\n2,off\n3,on\n4,on\n5,off\n6,on",
            {"filters": [("state", "eq", "ON")], "max_rows": 1, "offset": 2},
            ["4"],
            True,
            3,
        ),
        ("gauge,site\n1,Turku\n2,\n3,tulln", {"filters": [("site", "startswith", "TU")]}, ["1", "3"], False, None),
        ("gauge,site\n1,Turku\n2,\n3,tulln", {"filters": [("site", "isnull")]}, ["2"], False, None),
    ],
)
def test_csv_pages(spark, lake_file, content, options, expected, truncated, next_offset):
    found = csv_page(spark, lake_file("t.csv", content), **options)
    assert values(found.rows, "gauge") == expected
    assert (found.truncated, found.next_offset) == (truncated, next_offset)


def test_csv_without_header(spark, lake_file):
    df = read_csv(spark, lake_file("t.csv", "7,Oslo,x\n9,Turku,y\n9,,"), has_header=False)
    assert df.columns == ["column_0", "column_1", "column_2"]
    assert df.count() == 3


def test_csv_errors(spark, lake_file):
    df = read_csv(spark, lake_file("t.csv", "gauge,site\n7,Oslo"), position=True)
    with pytest.raises(ValueError, match="gauge, site"):
        page(df.select("gauge", "site"), [("depth", "eq", "x")])
    with pytest.raises(ValueError, match="isnotnull"):
        page(df, [("gauge", "like", "x")])


@pytest.mark.parametrize("multiline", [None, True])
def test_csv_cells(spark, lake_file, multiline):
    path = lake_file(
        "t.csv", 'id,name,amt\n1,,3\n2,"",\n3\n4,a,b,c\n\n5,"x ""q"" y",7\n6,"two\nlines, yes",8\n7,"",\n8,5" pipe,1\n'
    )
    rows = read_csv(spark, path, multiline=multiline).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [
        ("1", "", "3"),
        ("2", "", ""),
        ("3", None, None),
        ("4", "a", "b"),
        ("5", 'x "q" y', "7"),
        ("6", "two\nlines, yes", "8"),
        ("7", "", ""),
        ("8", '5" pipe', "1"),
    ]


def test_csv_mixed_files_keep_order(spark, lake_file):
    lake_file("a.csv", "id,t\n1,x\n2,y\n", "mixed")
    lake_file("b c.csv", 'id,t\n3,"x\n3b"\n4,z\n', "mixed")
    folder = lake_file("d.csv", "id,t\n5,w\n", "mixed").rsplit("/", 1)[0]
    assert values(csv_page(spark, folder).rows, "id") == ["1", "2", "3", "4", "5"]
    assert values(csv_page(spark, folder, max_rows=2, offset=2).rows, "id") == ["3", "4"]


def test_csv_blank_and_empty_lines(spark, lake_file):
    path = lake_file("t.csv", "a\n1\n\n   \n2\n")
    assert values(csv_page(spark, path).rows, "a") == ["1", "   ", "2"]


def test_csv_first_file_empty(spark, lake_file):
    lake_file("a.csv", "", "some")
    folder = lake_file("b.csv", "x,y\n1,2\n", "some").rsplit("/", 1)[0]
    assert [tuple(r) for r in csv_page(spark, folder).rows] == [("1", "2")]


@pytest.mark.parametrize("last", ["5", '"5\n6"'])
def test_csv_headers_must_agree(spark, lake_file, last):
    lake_file("a.csv", f"id,t\n1,{last}\n", "headers")
    folder = lake_file("b.csv", f"ID,T\n2,{last}\n", "headers").rsplit("/", 1)[0]
    assert read_csv(spark, folder).count() == 2
    lake_file("c.csv", f"t,id\n{last},3\n", "headers")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, folder).collect()


def test_csv_duplicate_header(spark, lake_file):
    path = lake_file("t.csv", "id,v,v\n1,a,b\n2,c,d\n")
    assert [tuple(r) for r in read_csv(spark, path).orderBy("id").collect()] == [("1", "b"), ("2", "d")]
    assert values(read_csv(spark, path, filters=[("V", "eq", "c")]).collect(), "v") == ["d"]


def test_csv_long_delimiter(spark, lake_file):
    df = read_csv(spark, lake_file("t.csv", "a||b\n1||\n2\n"), delimiter="||")
    assert [tuple(r) for r in df.orderBy("a").collect()] == [("1", ""), ("2", None)]


@pytest.fixture
def tools(spark, tmp_path):
    path = str(tmp_path / "tools")
    rows = spark.createDataFrame([(40, "loom"), (50, "kiln"), (60, "lathe"), (70, "anvil")], "Part int, Tool string")
    rows.coalesce(1).write.parquet(path)
    return read_parquet(spark, path, position=True)


@pytest.mark.parametrize(
    "options,expected,truncated,next_offset",
    [
        ({"max_rows": 50}, ["loom", "kiln", "lathe", "anvil"], False, None),
        ({"max_rows": 3}, ["loom", "kiln", "lathe"], True, 3),
        ({"max_rows": 3, "offset": 3}, ["anvil"], False, None),
        ({"offset": 4}, [], False, None),
        ({"columns": ["TOOL", "colour"], "filters": [("part", "lt", "60")]}, ["loom", "kiln"], False, None),
    ],
)
def test_parquet_pages(tools, options, expected, truncated, next_offset):
    found = page(tools, with_total=True, **options)
    assert values(found.rows, "Tool") == expected
    assert (found.truncated, found.next_offset) == (truncated, next_offset) and found.total_rows == 4
    if "columns" in options:
        assert found.columns == ["Tool"]
    with pytest.raises(ValueError, match="Part, Tool"):
        page(tools, [("colour", "eq", "1")])


def test_parquet_schema(spark, tools):
    path = tools.inputFiles()[0]
    assert [tuple(r)[:2] for r in parquet_schema(spark, path).collect()] == [("Part", "int"), ("Tool", "string")]


def test_pages_over_many_files(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(0, 4000, 1, 40).write.parquet(path)
    df = read_parquet(spark, path, position=True)
    in_order = [r[0] for r in df.orderBy(FILE, ROW).select("id").collect()]
    for offset, count in [(0, 5), (95, 20), (1234, 300), (3990, 50), (2000, 7)]:
        assert [r[0] for r in page_frame(df, None, count, offset).collect()] == in_order[offset : offset + count]
    even = [("id", "gte", "1000"), ("id", "lt", "1010")]
    expected = [i for i in in_order if 1000 <= i < 1010]
    assert [r[0] for r in page_frame(df, even, 4, 3).collect()] == expected[3:7]
    flags = page_flags(df, even, 4, 6).first()
    assert tuple(flags) == (4, False, 6, None)
    walked, last = [], None
    while True:
        rows = page_after(df, last, max_rows=1500).collect()
        if not rows:
            break
        walked += [r["id"] for r in rows]
        last = (rows[-1][FILE], rows[-1][ROW])
    assert walked == in_order


def test_pages_over_split_text(spark, lake_file):
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        expected = []
        for part in range(12):
            lines = [f"{part}-{i}" for i in range(1500)]
            expected += lines
            folder = lake_file(f"p{part:02d}.txt", "\n".join(lines) + "\n", "split").rsplit("/", 1)[0]
        df = read_text(spark, folder, position=True)
        for offset, count in [(0, 10), (1490, 25), (9000, 3000), (17_995, 10), (18_000, 5)]:
            found = [r[0] for r in page_frame(df, None, count, offset).collect()]
            assert found == expected[offset : offset + count]
        hits = read_text(spark, folder, contains="-149", position=True)
        wanted = [line for line in expected if "-149" in line]
        assert [r[0] for r in page_frame(hits, None, 30, 20).collect()] == wanted[20:50]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)


@pytest.mark.parametrize(
    "content,contains,options,expected,next_offset",
    [
        ("# Tide\nlow\nhigh\n", None, {"max_rows": 50}, ["# Tide", "low", "high"], None),
        ("p\nq\nr\ns", None, {"max_rows": 3}, ["p", "q", "r"], 3),
        ("p\nq\nr", None, {"max_rows": 3}, ["p", "q", "r"], None),
        ("p\nq\nr\ns", None, {"max_rows": 1, "offset": 2}, ["r"], 3),
        ("p", None, {"offset": 3}, [], None),
        ("low tide\nebb\nTIDE table\ntides\nneap", "tide", {"max_rows": 1, "offset": 1}, ["TIDE table"], 2),
        ("a\r\nb\rc\n\nd\n", None, {}, ["a", "b", "c", "", "d"], None),
    ],
)
def test_text(spark, lake_file, content, contains, options, expected, next_offset):
    found = page(read_text(spark, lake_file("t.md", content), contains, position=True), **options)
    assert values(found.rows, "value") == expected
    assert found.next_offset == next_offset


FLEET = (
    '<Fleet><Boat no="A7"><Berth>east</Berth><Draft>2.5</Draft></Boat>'
    '<Boat no="B2"><Berth>west</Berth><Draft>11</Draft></Boat>'
    '<Boat no="C9"><Berth>quay</Berth><Draft>7</Draft></Boat>'
    '<Boat no="D1"><Berth>mole</Berth><Draft>30</Draft></Boat></Fleet>'
)
HARBOUR = (
    "<Harbour><Office><Warden>w</Warden></Office><Boat no='1'><Berth>east</Berth></Boat><Pier><Boat no='8'/></Pier>"
    "<boat no='2'><Berth>west</Berth></boat></Harbour>"
)


def xml_page(spark, path, max_rows=None, offset=0, **read):
    return page(read_xml(spark, path, position=True, **read), None, max_rows, offset)


def test_xml_pages(spark, lake_file):
    path = lake_file("p.xml", FLEET)
    assert [tuple(r) for r in xml_schema(spark, path).collect()] == [("no", True), ("Berth", False), ("Draft", False)]
    everything = xml_page(spark, path)
    assert everything.columns == ["no", "Berth", "Draft"]
    assert [tuple(r) for r in everything.rows][1:3] == [("B2", "west", "11"), ("C9", "quay", "7")]
    first = xml_page(spark, path, max_rows=3)
    assert (len(first.rows), first.truncated, first.next_offset) == (3, True, 3)
    assert values(xml_page(spark, path, offset=2).rows, "Berth") == ["quay", "mole"]
    assert values(xml_page(spark, path, columns=["Draft"]).rows, "Draft") == ["2.5", "11", "7", "30"]
    both = [("Draft", "lte", "11"), ("no", "ne", "a7")]
    assert values(xml_page(spark, path, filters=both).rows, "Berth") == ["west", "quay"]
    one = xml_page(spark, path, max_rows=1, filters=[("Draft", "gt", "7")])
    assert (values(one.rows, "Berth"), one.truncated, one.next_offset) == (["west"], True, 1)
    odd = xml_page(spark, path, columns=["DRAFT", "flag", "No"])
    assert odd.columns == ["DRAFT", "flag", "No"]
    assert tuple(odd.rows[1]) == ("11", None, "B2")
    with pytest.raises(ValueError, match="no, Berth, Draft"):
        read_xml(spark, path, filters=[("flag", "eq", "1")])


def test_xml_record_name(spark, lake_file):
    path = lake_file("c.xml", HARBOUR)
    assert values(xml_page(spark, path, record="BOAT").rows, "Berth") == ["east", "west"]
    assert xml_page(spark, path).columns == ["Warden"]
    assert len(xml_page(spark, path).rows) == 4
    assert xml_schema(spark, path, "nothing").count() == 0


def test_xml_cells(spark, lake_file):
    path = lake_file(
        "e.xml",
        '<?xml version="1.0"?>\n<r xmlns:a="urn:x" v="9">\n  <!-- <p id="0"/> -->\n'
        '  <a:p id="1" xmlns:z="urn:z"><id>hidden</id><n>one</n><n>two</n><e/><c><![CDATA[a<b]]></c>'
        "<d>x<b>y</b>z</d><t>&lt;i&gt; &amp; 1</t></a:p>\n"
        "  <p id='2'><n> sp </n><e>   </e><d>q</d></p>\n</r>",
    )
    rows = xml_page(spark, path).rows
    assert rows[0].asDict() == {
        "id": "1", "n": "one", "e": "", "c": "a<b", "d": "xyz", "t": "<i> & 1",
    }
    assert rows[1].asDict() == {"id": "2", "n": " sp ", "e": "", "c": None, "d": "q", "t": None}


def test_xml_record_far_from_the_head(spark, lake_file, monkeypatch):
    monkeypatch.setattr(xml, "HEAD_TAGS", 16)
    long = "".join(f"<f{i}>{i}</f{i}>" for i in range(40))
    others = "".join(f"<Other id='{i}'><x>1</x></Other>" for i in range(100))
    path = lake_file("far.xml", f"<r xmlns:a='urn:a'>{others}<a:P n='1'>{long}</a:P><a:P n='2'><f3>z</f3></a:P></r>")
    assert xml_schema(spark, path, "p").count() == 41
    assert xml_schema(spark, path, "q").count() == 0
    found = xml_page(spark, path, record="p", columns=["n", "f3"])
    assert [tuple(row) for row in found.rows] == [("1", "3"), ("2", "z")]
    lake_file("a.xml", "<r/>", "several")
    several = lake_file("b.xml", "<r><P><k>1</k></P></r>", "several").rsplit("/", 1)[0]
    assert [tuple(row) for row in xml_page(spark, several).rows] == [("1",)]
    assert [tuple(row) for row in xml_page(spark, several, record="P").rows] == [("1",)]
    whole = lake_file("whole.xml", f"<r><P>{long}</P></r>")
    assert xml_schema(spark, whole).count() == 40


def test_xml_strict_depth_and_doctype(spark, lake_file):
    path = lake_file("n.xml", "<r><p><k>1</k><p><k>2</k></p></p><p><k>3</k></p></r>")
    assert values(xml_page(spark, path).rows, "k") == ["1", "3"]
    cut_off = lake_file("c.xml", "<r><p><k>1</k></p><p><k>2</k>")
    with pytest.raises(Exception, match="no element found"):
        read_xml(spark, cut_off).collect()
    bad = lake_file("d.xml", '<!DOCTYPE r [<!ENTITY e "x">]><r><p><k>&e;</k></p></r>')
    with pytest.raises(ValueError, match="DOCTYPE"):
        read_xml(spark, bad)


def test_xml_over_splits(spark, lake_file):
    rng = random.Random(5)
    names = ["Product", "a:Product", "product"]
    expected, parts = [], ['<?xml version="1.0"?>\n<!-- all --><Products xmlns:a="urn:a" xmlns="urn:p">\n']
    for i in range(300):
        note = "".join(rng.choice("xy &lt;&amp;é>\n") for _ in range(rng.randint(1, 60))).strip() or "-"
        plain = note.replace("&lt;", "<").replace("&amp;", "&")
        note, plain = ("n", "n") if plain.count("&") != note.count("&amp;") else (note, plain)
        name = rng.choice(names)
        if i % 7 == 3:
            parts.append(f'<{name} id="{i}" t="a>b/"/>')
            expected.append((str(i), "a>b/", None, None))
        else:
            parts.append(f"<{name} t='q' id='{i}'><Note>{note}</Note><!-- c --><Tail><![CDATA[z]]></Tail></{name}>")
            expected.append((str(i), "q", plain, "z"))
        if i % 50 == 0:
            parts.append("<Other><Product id='no'/></Other>")
    path = lake_file("big.xml", "\n".join(parts) + "</Products>\n", "xml")
    lake_file("bigger.xml", "<Products><!-- <x> --><Product id='z' t='y'><Note>n</Note></Product></Products>", "xml")
    expected.append(("z", "y", "n", None))
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        columns = ["id", "t", "Note", "Tail"]
        folder = path.rsplit("/", 1)[0]
        df = read_xml(spark, folder, "product", columns, position=True)
        assert [tuple(row) for row in page(df, max_rows=1000).rows] == expected
        assert [tuple(row) for row in page(df, max_rows=20, offset=150).rows] == expected[150:170]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)


def test_projections(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "Id int, Name string, Amount double")
    assert project_existing(df, ["amount", "ID", "zzz"]).columns == ["Id", "Amount"]
    assert project_existing(df, None).columns == df.columns
    asked = project_requested(df, ["amount", "zzz", "ID"])
    assert asked.columns == ["amount", "zzz", "ID"]
    assert tuple(asked.first()) == (2.0, None, 1)


def test_list_directory(spark, lake_file):
    lake_file("a.csv", "x", "lake")
    root = lake_file("b.csv", "xyz", "lake/sub/deep").split("/sub/")[0]
    flat = {(r["name"], r["is_directory"], r["length"]) for r in list_directory(spark, root).collect()}
    assert flat == {("a.csv", False, 1), ("sub", True, None)}
    names = {r["name"] for r in list_directory(spark, root, recursive=True).collect()}
    assert names == {"a.csv", "sub", "sub/deep", "sub/deep/b.csv"}


def test_page_plan(spark, sf_dir, capsys):
    orders = read_parquet(spark, f"{sf_dir}/orders.parquet", position=True)
    page_frame(orders, [("o_totalprice", "gt", "1000")], 10, 5).select("o_orderkey").explain("formatted")
    plan = capsys.readouterr().out
    assert "TakeOrderedAndProject" in plan and "GreaterThan(o_totalprice,1000.0)" in plan
    schema = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "o_custkey" not in schema and "o_orderkey" in schema


def test_pages_list_only_their_files(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(0, 400, 1, 40).write.parquet(path)
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = read_parquet(spark, path, position=True)
        files = input_files(df)
        assert df.rdd.getNumPartitions() == 40
        assert _within_files(df, files[3], files[5]).rdd.getNumPartitions() == 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)


def random_rows(rng, count, width, alphabet):
    return [["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 8))) for _ in range(width)] for _ in range(count)]


def write_rows(target, rows, **dialect):
    with open(target, "w", newline="") as opened:
        csv.writer(opened, **dialect).writerows(rows)


@pytest.mark.parametrize("seed,delimiter,quoting", [(1, ",", csv.QUOTE_MINIMAL), (2, ";", csv.QUOTE_ALL)])
def test_random_csv(spark, tmp_path, seed, delimiter, quoting):
    rng = random.Random(seed)
    rows = random_rows(rng, 400, 3, 'ab12"' + delimiter + " '\\é\n")
    header = [["x", "y two\nlines", "z"]]
    folder = tmp_path / "random"
    folder.mkdir()
    dialect = {"delimiter": delimiter, "quoting": quoting}
    write_rows(folder / "0.csv", header + rows[:150], lineterminator="\n", **dialect)
    write_rows(folder / "1.csv", header + rows[150:], lineterminator="\r\n", **dialect)
    write_rows(folder / "2.csv", [*header, ["k", "l", ""]], lineterminator="\n", **dialect)
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        df = read_csv(spark, str(folder), delimiter, position=True)
        assert df.columns[1] == header[0][1]
        assert [list(row) for row in page(df, max_rows=1000).rows] == [*rows, ["k", "l", ""]]
        assert [list(row) for row in page(df, max_rows=40, offset=130).rows] == rows[130:170]
        assert check_csv_files(spark, str(folder), delimiter).count() == 0
        write_rows(folder / "3.csv", [*header, *rows[:100], ["a\nb"], *rows[:50], ["c"]], lineterminator="\n", **dialect)
        bad = check_csv_files(spark, str(folder), delimiter).collect()
        assert [tuple(row)[1:] for row in bad] == [(102, 1, 3, 2)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)


def test_csv_odd_quotes(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text('a,b\n5" pipe,1\n"x\n5"",y",2\n"""",3\nu"v","w\n\n",\n,"z"\n')
    df = read_csv(spark, str(path), position=True)
    assert [tuple(row) for row in page(df).rows] == [
        ('5" pipe', "1"), ('x\n5",y', "2"), ('"', "3"), ('u"v"', "w\n\n"), ("", "z"),
    ]


def test_some_files_with_long_records(spark, lake_file):
    lake_file("a.csv", "id,t\n1,x\n2,y\n", "named")
    folder = lake_file("b.csv", 'id,t\n3,"x\n3b"\n4,z\n', "named").rsplit("/", 1)[0]
    found = csv_page(spark, folder)
    assert [tuple(row) for row in found.rows] == [("1", "x"), ("2", "y"), ("3", "x\n3b"), ("4", "z")]
    path = lake_file("c.xml", "<r><!-- <p> --><p><k>1</k></p></r>")
    assert values(page(read_xml(spark, path, "p", position=True)).rows, "k") == ["1"]


def test_xml_routes_agree(spark, lake_file):
    """The same records in a file that is cut and in one that is read whole, late spellings and nesting included."""
    body = "<Hall>" + "<Lamp no='1'><Kind>a</Kind></Lamp>" * 60 + "<Rack><Lamp no='x'/></Rack>"
    body += "<lamp no='2'><Kind>x<i>y</i>z &lt;b&gt;</Kind></lamp><k:LAMP xmlns:k='urn:k' no='3'/></Hall>"
    cut = lake_file("cut.xml", body)
    whole = lake_file("whole.xml", body.replace("<Hall>", "<Hall><!-- <x> -->"))
    for record in ("lamp", None):
        rows = [xml_page(spark, path, record=record, columns=["no", "Kind"]).rows for path in (cut, whole)]
        assert [tuple(r) for r in rows[0]] == [tuple(r) for r in rows[1]]
        assert len(rows[0]) == (62 if record else 63)
        assert [tuple(r) for r in rows[0]][-2:] == [("2", "xyz <b>"), ("3", None)]


def test_parquet_files_of_two_schemas(spark, tmp_path):
    path = str(tmp_path / "two")
    spark.createDataFrame([(1, "x")], "id int, left string").write.parquet(path)
    spark.createDataFrame([(2, "y")], "id int, right string").write.mode("append").parquet(path)
    found = {r["id"]: (r["left"], r["right"]) for r in read_parquet(spark, path).collect()}
    assert found == {1: ("x", None), 2: (None, "y")}


def test_folder_reads_only_chosen_files(spark, lake_file):
    lake_file("a.csv", "k;v;extra\n1;2;3\n", "chosen")
    folder = lake_file("b.csv", "k;v\n5;6\n", "chosen").rsplit("/", 1)[0]
    rows = read_folder(spark, folder, files=["b"])
    assert rows.columns == ["k", "v", "project_file"] and [tuple(r) for r in rows.collect()] == [("5", "6", "b")]
    assert len(rows.inputFiles()) == 1
    assert read_folder(spark, folder, files=["zzz"]).count() == 0


CELLS = (
    "<r><k a='1 &lt; &amp;amp; \"2\"'><K>x<i>y</i>z &lt;b&gt; w &lt;c d</K><L><![CDATA[ <b>&amp; ]]> <i q=\"a>b\">t</i> <!-- c --> u</L>"
    "<M>&#32;</M><N> <i/> </N><O>a &gt; b > <u>c</u></O><P><![CDATA[<a>]]></P></k><k><K/><P>&#x41;&quot;]]&gt;</P></k></r>"
)


@pytest.mark.parametrize("before", ["<r>", "<r><z/>", "<r><!-- <x> -->"])
def test_xml_cell_text(spark, lake_file, before):
    """Escaped markup, sections, comments and inner tags, by each of the three ways a file is read."""
    path = lake_file("cells.xml", CELLS.replace("<r>", before))
    rows = xml_page(spark, path, record="k", columns=["a", "K", "L", "M", "N", "O", "P"]).rows
    assert tuple(rows[0]) == ('1 < &amp; "2"', "xyz <b> w <c d", " <b>&amp; t u", "", "", "a > b > c", "<a>")
    assert tuple(rows[1]) == (None, "", None, None, None, None, 'A"]]>')


def test_xml_even_files(spark, lake_file):
    """Which files are cut at their end tags, and that small splits and a missing piece change nothing."""
    record = "<P n='1'><k>1</k></P>"
    even = [f"<r>{record * 3}</r>", f'<?xml version="1.0"?>\n<!-- x -->\n<r a="b>"> {record} \n{record}</r>\n', f"<r>{record}<P n='2'><!-- y --><k><![CDATA[z]]></k></P></r>"]
    uneven = ["<r/>", "<r></r>", f"<r>{record}<Q/></r>", f"<r><Q>{record}</Q></r>", f"<r>{record}<p n='2'/></r>", f"<r>{record}<P n='2'/></r>", f"<P>{record}</P>"]
    uneven += [f"<r><P><P/></P>{record}</r>", f"<r>{record}<!-- </P><P> --></r>", f"<r>{record}<P><k>2</k>", f"<r>{record}</r><r>{record}</r>"]
    for i, text in enumerate([*even, *uneven]):
        lake_file(f"{i:02d}.xml", text, "shapes")
    folder = lake_file("zz.xml", even[0], "shapes").rsplit("/", 1)[0]
    found = sorted(row[0].rsplit("/", 1)[1] for row in xml_split.uneven_files(spark, folder, "P").collect())
    assert found == [f"{i:02d}.xml" for i in range(len(even), len(even) + len(uneven))]
    many = lake_file("many.xml", "<r>" + "".join(f"<P n='{i}'><k>é{i}</k></P>" for i in range(500)) + "</r>")
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "701")
    try:
        assert [tuple(row) for row in xml_page(spark, many, max_rows=1000).rows] == [(str(i), f"é{i}") for i in range(500)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)


def test_xml_folder(spark, lake_file):
    lake_file("a.xml", "<r><P n='1'><k>1</k></P><P n='2'><later>x</later></P></r>", "xmls")
    lake_file("b.xml", "<r><!-- <x> --><p M='3'><K>2</K><z>q</z></p></r>", "xmls")
    folder = lake_file("c.xml", "<r><Q/><P><l>&lt;</l></P></r>", "xmls").rsplit("/", 1)[0]
    rows = read_folder(spark, folder, "xml", record="p")
    assert rows.columns == ["n", "k", "l", "M", "z", "project_file"]
    assert sorted((tuple(r) for r in rows.collect()), key=str) == sorted(
        [("1", "1", None, None, None, "a"), ("2", None, None, None, None, "a"), (None, "2", None, "3", "q", "b"), (None, None, "<", None, None, "c")], key=str
    )


def test_opening_csv_starts_no_scan(spark, lake_file):
    """Only the first record is looked at; a file with long records is found while the plan runs."""
    lake_file("a.csv", "k,v\n" + "1,x\n" * 50, "lazy")
    folder = lake_file("b.csv", 'k,v\n2,"x\ny"\n', "lazy").rsplit("/", 1)[0]
    rows = read_csv(spark, folder)
    lake_file("b.csv", 'k,v\n2,"x\ny\nz"\n', "lazy")
    spark.catalog.refreshByPath(folder)
    assert sorted({tuple(r) for r in rows.collect()}) == [("1", "x"), ("2", "x\ny\nz")]
    plain = lake_file("p.csv", "k,v\n1,x\n2,y\n")
    lines = read_csv(spark, plain)
    assert lines.count() == 2 and "CartesianProduct" not in lines._jdf.queryExecution().toString()


def test_walk(spark, tmp_path):
    """All pages of a CSV, a text and a Parquet folder, filtered, forwards and at any offset, against the whole."""
    rows = [(i, f"w{i % 7}") for i in range(900)]
    df = spark.createDataFrame(rows, "id int, word string").repartitionByRange(5, "id").sortWithinPartitions("id")
    df.write.csv(str(tmp_path / "c"), header=True)
    df.select(F.concat_ws(",", "id", "word").alias("value")).write.text(str(tmp_path / "t"))
    df.write.parquet(str(tmp_path / "p"))
    wanted = [i for i, word in rows if word in ("w1", "w3", "w5")]
    scans = {
        "c": (read_csv(spark, str(tmp_path / "c"), position=True), lambda r: int(r["id"])),
        "t": (read_text(spark, str(tmp_path / "t"), position=True), lambda r: int(r["value"].split(",")[0])),
        "p": (read_parquet(spark, str(tmp_path / "p"), position=True), lambda r: r["id"]),
    }
    for name, (scan, key) in scans.items():
        odd = scan.filter(F.col("value" if name == "t" else "word").rlike("w[135]$"))
        walk = Walk(odd)
        assert walk.total() == len(wanted)
        pages = list(walk.pages(100))
        assert [key(r) for page_ in pages for r in page_.rows] == wanted and [p.next_offset for p in pages][:-1] == [100, 200, 300][: len(pages) - 1]
        assert [key(r) for r in walk.page(250, 30).rows] == wanted[250:280] and walk.page(10_000).rows == []
    parquet = scans["p"][0]
    for offset in (0, 177, 180, 500, 899, 900):
        assert [r["id"] for r in page(parquet, None, 120, offset).rows] == list(range(offset, min(900, offset + 120)))
    assert [r["id"] for r in page(parquet.filter("id % 2 = 0"), None, 10, 100).rows] == list(range(200, 220, 2))
