"""Raw reading, type inference and typed load on rows written by hand."""

import csv
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text_values import value_class
from tidemark.operators import inference
from tidemark.sources import loader
from tidemark.sources.csv_tables import has_broken_lines, read_raw_csv
from tidemark.sources.storage import clear_leftovers, current_loads, read_table


def write_csv(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows(rows)
    return str(path)


def test_value_classes(spark):
    expected = {
        "0123": "code", "05/01/2024": "code", "1234567890123456": "code", "00": "code",
        "0": "integer", "12": "integer", " 12 ": "integer", "1_000": "integer", "+5": "integer",
        "-7": "integer", "123456789012345": "integer",
        "0.5": "number", "nan": "number", "-Inf": "number", "1e5": "number", "1_0.5": "number",
        "1.": "number", ".5": "number", "12345678901234567.5": "number",
        "true": "boolean", "FALSE": "boolean",
        "2024-1-5": "date", "2024-01-05 10:11:12": "date", "2024-01-05  10:11:12": "date",
        "15/1/2024": "date", "15/01/2024 10:00:00": "date",
        "1d": "text", "0x1p3": "text", "24-1-5": "text", "2024-02-30": "text", " ": "text",
        "2024-01-05 ": "text", "2024-01-05T10:11:12": "text", "2024-01-05 10:11:12.5": "text",
        "1__0": "text", "abc": "text", "Tuesday": "text", " true": "text", "true\n": "text", "-": "text",
    }
    rows = spark.createDataFrame([(v,) for v in expected], "v string").select(
        "v", value_class(F.col("v")).alias("kind")
    )
    assert {r.v: r.kind for r in rows.collect()} == expected


def test_column_types(spark):
    columns = {
        "empty": (["", None], "TEXT"),
        "flag": (["TRUE", "false", ""], "BOOLEAN"),
        "small": (["1", "-2147483647", ""], "INTEGER"),
        "big": (["1", "2147483648", ""], "BIGINT"),
        "mixed_number": (["1", "2.50", ""], "NUMERIC"),
        "special": (["1", "1e5", ""], "NUMERIC"),
        "stamp": (["2024-01-05", "2024-01-05 10:00:00", ""], "TIMESTAMP"),
        "one_code": (["12", "012", "13"], "TEXT"),
        "day_first": (["15/01/2024", "05/01/2024", ""], "TEXT"),
        "flag_and_number": (["TRUE", "1", ""], "TEXT"),
    }
    height = max(len(v) for v, _ in columns.values())
    rows = [tuple((v + [None] * height)[i] for v, _ in columns.values()) for i in range(height)]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    types = {r["column"]: r for r in inference.infer_column_types(raw).collect()}
    assert {c: r["type"] for c, r in types.items()} == {c: t for c, (_, t) in columns.items()}
    assert types["mixed_number"]["spark_type"] == "decimal(18,2)"
    assert types["special"]["spark_type"] == "decimal(18,2)"
    example = inference.code_examples({"t": raw}).collect()
    assert {(r["column"], r["sample_code"]) for r in example} == {("one_code", "012"), ("day_first", "05/01/2024")}


def test_types_of_an_empty_table(spark):
    raw = spark.createDataFrame([], "id string, name string")
    assert [r["type"] for r in inference.infer_column_types(raw).orderBy("pos").collect()] == ["TEXT", "TEXT"]


# Invented rows, one table per kind of trap; the types are written down by hand.
TRAPS = {
    "people": {
        "id": (["1", "2", "3"], "INTEGER PRIMARY KEY"),
        "tax_no": (["31415926535", "27182818284", ""], "BIGINT"),
        "badge": (["0042", "1042", "2042"], "TEXT"),
        "mobile": (["03098765432", "4930123456789", ""], "TEXT"),
        "zip": (["12345-678", "87654321", "10203-040"], "TEXT"),
        "born": (["1999-12-31", "2000-1-1", ""], "TIMESTAMP"),
        "left_at": (["", "2021-03-04 05:06:07", ""], "TIMESTAMP"),
        "day_first": (["15/1/2024", "31/12/2023", ""], "TIMESTAMP"),
        "day_first_zero": (["05/01/2024", "31/12/2023", ""], "TEXT"),
        "active": (["TRUE", "false", ""], "BOOLEAN"),
        "note": (["", "", ""], "TEXT"),
    },
    "amounts": {
        "Id": (["10", "11", "12"], "INTEGER PRIMARY KEY"),
        "rate": (["7", "7.25", ""], "NUMERIC"),
        "price": (["1e2", "12.5", "3E-2"], "NUMERIC"),
        "grouped": (["1_000", "+5", " 12 "], "INTEGER"),
        "large": (["2147483648", "-1", "0"], "BIGINT"),
        "longest": (["999999999999999", "1", ""], "BIGINT"),
        "sixteen": (["1234567890123456", "1", ""], "TEXT"),
        "missing": (["nan", "1.5", ""], "NUMERIC"),
        "zero": (["0", "0.5", "0"], "NUMERIC"),
    },
    "oddities": {
        "key": (["a", "b", "c"], "TEXT"),
        "hexadecimal": (["0x1p3", "1", ""], "TEXT"),
        "suffix": (["1d", "2", ""], "TEXT"),
        "twice": (["1__0", "1", ""], "TEXT"),
        "short_year": (["24-1-5", "2024-1-5", ""], "TEXT"),
        "no_day": (["2024-02-30", "2024-02-28", ""], "TEXT"),
        "blank": ([" ", "1", ""], "TEXT"),
        "mixed_flag": (["true", "1", ""], "TEXT"),
        "fraction": (["1_0.5", ".5", "1."], "NUMERIC"),
    },
}


def test_ddl_of_traps(spark, tmp_path):
    raw = {}
    for table, columns in TRAPS.items():
        rows = [list(columns)] + [[cells[i] for cells, _ in columns.values()] for i in range(3)]
        raw[table] = read_raw_csv(spark, write_csv(tmp_path / f"{table}.csv", rows))
    ddl = inference.ddl_for(inference.infer_folder_types(raw), loader.row_counts(raw))
    for r in ddl.collect():
        columns = TRAPS[r["table"]]
        lines = ",\n".join(f"    {c} {t}" for c, (_, t) in columns.items())
        assert (r["ddl"], r["n_columns"], r["n_rows"]) == (f"CREATE TABLE {r['table']} (\n{lines}\n);", len(columns), 3)
    assert ddl.count() == len(TRAPS)


def python_class(v):
    """The rules in plain Python, as a loader would try them."""
    if (len(v) > 1 and v[0] == "0" and v[1].isdigit()) or (len(v) > 15 and accepts(int, v)):
        return "code"
    if v.upper() in ("TRUE", "FALSE"):
        return "boolean"
    if accepts(int, v):
        return "integer"
    if accepts(float, v):
        return "number"
    forms = ["%Y-%m-%d", "%d/%m/%Y"]
    return "date" if any(accepts(lambda x: datetime.strptime(x, f), v) for d in forms for f in (d, f"{d} %H:%M:%S")) else "text"


def accepts(parse, v):
    try:
        parse(v)
    except ValueError:
        return False
    return True


def test_classes_are_those_of_python(spark):
    cells = {c for columns in TRAPS.values() for values, _ in columns.values() for c in values if c}
    rng = random.Random(3)
    for c in sorted(cells):
        for _ in range(12):
            i = rng.randrange(len(c) + 1)
            cells.add(c[:i] + rng.choice("0159_+-. /:eE") + c[i + rng.randint(0, 1) :])
    cells -= {""}
    rows = spark.createDataFrame([(c,) for c in sorted(cells)], "v string").select("v", value_class(F.col("v")).alias("kind"))
    wrong = {r.v: (r.kind, python_class(r.v)) for r in rows.collect() if r.kind != python_class(r.v)}
    assert not wrong


def test_exact_numbers(spark, tmp_path):
    long = "1234567890123456789012345678901234567.1234"
    path = write_csv(tmp_path / "n.csv", [["id", "wide", "price", "far"], ["1", long, "1e2", "1e400"], ["2", "1.5", "0.05", "2.5"]])
    types = inference.infer_column_types(read_raw_csv(spark, path))
    found = {r["column"]: (r["type"], r["spark_type"]) for r in types.collect()}
    assert found == {"id": ("INTEGER", "int"), "wide": ("NUMERIC", "string"), "price": ("NUMERIC", "decimal(18,2)"), "far": ("NUMERIC", "string")}
    folder, dest = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    write_csv(folder / "n.csv", [["id", "wide", "price", "far"], ["1", long, "1e2", "1e400"], ["2", "1.5", "0.05", "2.5"]])
    result = loader.load_folder(spark, str(folder), dest)[0]
    assert (result.status, result.error) == ("loaded", "kept as text, more than 38 digits: far, wide")
    rows = read_table(spark, f"{dest}/n").orderBy("id").collect()
    assert [(r.wide, str(r.price)) for r in rows] == [(long, "100.00"), ("1.5", "0.05")]


@pytest.mark.parametrize("cell", ["1 2", "__5", "4_", "1.5", "5 _ 5", "1e2", "x", "2147483648"])
def test_cells_that_are_no_integer_fail(spark, tmp_path, cell):
    path = write_csv(tmp_path / "t.csv", [["id"], ["7"], [cell]])
    schema = T.StructType([T.StructField("id", T.IntegerType())])
    with pytest.raises(Exception, match="not int"):
        loader.load_table(spark, path, schema, str(tmp_path / "t"))
    assert not current_loads(spark, str(tmp_path / "t"))


def test_decimal_cells_are_not_rounded(spark, tmp_path):
    schema = T.StructType([T.StructField("p", T.DecimalType(10, 2))])
    path = write_csv(tmp_path / "t.csv", [["p"], ["1.234"]])
    with pytest.raises(Exception, match="not decimal"):
        loader.load_table(spark, path, schema, str(tmp_path / "t"))
    path = write_csv(tmp_path / "u.csv", [["p"], ["1_0.500"]])
    loader.load_table(spark, path, schema, str(tmp_path / "u"))
    assert str(read_table(spark, str(tmp_path / "u")).first().p) == "10.50"


def test_append_and_fixed_types(spark, tmp_path):
    folder, dest = tmp_path / "csv", str(tmp_path / "tables")
    folder.mkdir()

    def load(rows, **options):
        write_csv(folder / "t.csv", rows)
        return loader.load_folder(spark, str(folder), dest, mode="append", **options)[0]

    rows = lambda: sorted(tuple(r) for r in read_table(spark, f"{dest}/t").collect())
    assert load([["id", "b"], ["1", "2"]]).status == "loaded"
    assert "already in the table" in load([["id", "b"], ["2", "3"], ["1", "2"]]).error
    assert load([["id", "b"], ["3", "x7"]]).status == "failed"
    assert "columns" in load([["id", "b", "c"], ["3", "4", "5"]]).error
    assert load([["b", "id"], ["4", "3"]]).status == "loaded" and rows() == [(1, 2), (3, 4)]
    assert "unknown table" in load([["id", "b"], ["9", "9"]], schemas={}).error
    assert rows() == [(1, 2), (3, 4)] and clear_leftovers(spark, f"{dest}/t") == 0


def test_load_cut_off_leaves_the_table(spark, tmp_path, monkeypatch):
    dest = str(tmp_path / "t")
    schema = T.StructType([T.StructField("id", T.IntegerType())])
    loader.load_table(spark, write_csv(tmp_path / "a.csv", [["id"], ["1"]]), schema, dest)

    class Cut(BaseException):
        """A stop that no handler sees, as when the driver dies."""

    def stop(*_, **__):
        raise Cut

    with monkeypatch.context() as m:
        m.setattr(loader, "commit", stop)
        with pytest.raises(Cut):
            loader.load_table(spark, write_csv(tmp_path / "b.csv", [["id"], ["2"]]), schema, dest)
    assert [r.id for r in read_table(spark, dest).collect()] == [1]
    with pytest.raises(Exception):
        loader.load_table(spark, write_csv(tmp_path / "c.csv", [["id"], ["x"]]), schema, dest)
    assert [r.id for r in read_table(spark, dest).collect()] == [1]
    assert clear_leftovers(spark, dest) == 1
    loader.load_table(spark, write_csv(tmp_path / "b.csv", [["id"], ["2"]]), schema, dest)
    assert [r.id for r in read_table(spark, dest).collect()] == [2]


def test_csv_quoting(spark, tmp_path):
    rows = [["id", "a", "b"], ["1", "", "x,y"], ["2", 'say "hi"', "line\nbreak"], ["3", " pad ", "é"]]
    path = write_csv(tmp_path / "t.csv", rows)
    assert has_broken_lines(spark, path)
    found = [tuple(r) for r in read_raw_csv(spark, path).orderBy("id").collect()]
    assert found == [("1", None, "x,y"), ("2", 'say "hi"', "line\nbreak"), ("3", " pad ", "é")]
    flat = write_csv(tmp_path / "flat.csv", [["id", "a"], ["1", 'in "quotes"']])
    assert not has_broken_lines(spark, flat)
    (tmp_path / "short.csv").write_text("id,a\n1\n2,x\n")
    assert [r.a for r in read_raw_csv(spark, str(tmp_path / "short.csv")).orderBy("id").collect()] == [None, "x"]


@pytest.mark.parametrize("split", ["40", "1000", "128m"])
def test_csv_with_broken_lines_is_split(spark, tmp_path, split):
    rng = random.Random(7)
    cells = ["", "a", 'say "hi"', "x,y", "two\nlines", 'three\n"quoted"\nlines', "é\n\n,", "z" * 90 + "\n" + "y" * 90, " pad "]
    for part in range(2):
        rows = [["id", "a", "b c"]] + [[f"{part}-{i}", rng.choice(cells), rng.choice(cells)] for i in range(60)]
        write_csv(tmp_path / f"part{part}.csv", rows)
    plain = spark.read.csv(str(tmp_path), header=True, quote='"', escape='"', multiLine=True)
    want = sorted(tuple(r) for r in plain.collect())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        raw = read_raw_csv(spark, str(tmp_path))
        assert raw.columns == ["id", "a", "b c"]
        assert sorted(tuple(r) for r in raw.collect()) == want and len(want) == 120
        scans = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
        assert scans > 8 or split != "40"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_load_folder(spark, tmp_path):
    folder, dest = tmp_path / "csv", str(tmp_path / "tables")
    folder.mkdir()
    write_csv(folder / "good.csv", [
        ["id", "total", "flag", "at", "code", "note"],
        ["1", "10.50", "TRUE", "2024-01-05 10:00:00", "007", ""],
        ["2", "1_0", "FALSE", "15/1/2024", "012", "two\nlines"],
    ])
    write_csv(folder / "repeated.csv", [["id", "v"], ["1", "a"], ["1", "b"]])
    write_csv(folder / "missing.csv", [["id", "v"], ["1", "a"], ["", "b"]])
    write_csv(folder / "links.csv", [["a", "b"], ["1", "2"], ["1", "2"]])
    (folder / "ragged.csv").write_text("id,v\n1,a\n2\n")

    for _ in range(2):
        results = loader.load_folder(spark, str(folder), dest)
    audit = {r["table"]: (r["rows"], r["status"]) for r in loader.load_audit(spark, results).collect()}
    assert audit == {
        "good": (2, "loaded"), "links": (2, "loaded"), "missing": (None, "failed"),
        "ragged": (None, "failed"), "repeated": (None, "failed"),
    }
    summary = loader.load_summary(loader.load_audit(spark, results)).first()
    assert tuple(summary) == (4, 3, "missing, ragged, repeated")

    good = read_table(spark, f"{dest}/good")
    assert good.dtypes == [
        ("id", "int"), ("total", "decimal(18,2)"), ("flag", "boolean"), ("at", "timestamp_ntz"),
        ("code", "string"), ("note", "string"),
    ]
    assert [(str(r.total), str(r.at), r.code, r.note) for r in good.orderBy("id").collect()] == [
        ("10.50", "2024-01-05 10:00:00", "007", None), ("10.00", "2024-01-15 00:00:00", "012", "two\nlines"),
    ]

    # A table that fails later keeps its old rows; a cell that does not fit its type is a failure.
    write_csv(folder / "good.csv", [good.columns, ["1", "x", "", "", "", ""]])
    failed = loader.load_folder(spark, str(folder), dest, tables=["good"])
    assert failed[0].status == "failed" and "not decimal" in failed[0].error
    assert read_table(spark, f"{dest}/good").count() == 2

    # Append adds the rows once more each time.
    loader.load_folder(spark, str(folder), dest, mode="append", tables=["links"])
    assert read_table(spark, f"{dest}/links").count() == 4
    assert loader.reconciliation_total(
        {"a": read_table(spark, f"{dest}/links"), "b": good}
    ).first()[0] == 6
    assert clear_leftovers(spark, f"{dest}/good") == 1


def test_write_ddl(spark, tmp_path):
    raw = spark.createDataFrame([("1", "x")], "ID string, name string")
    ddl = inference.ddl_for(inference.infer_folder_types({"b": raw, "a": raw}))
    inference.write_ddl(ddl, str(tmp_path / "ddl"))
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "ddl")).collect())
    assert text == "\n\n".join(
        f"CREATE TABLE {t} (\n    ID INTEGER PRIMARY KEY,\n    name TEXT\n);" for t in "ab"
    )


@pytest.mark.parametrize("split", ["40", "128m"])
def test_csv_quote_inside_a_plain_cell(spark, tmp_path, split):
    lines = ["id,a,b"] + [f"{i},plain,x" for i in range(20)] + ['20,3" pipe,x', '21,"two\nlines",y', '22,a"b"",c"', '23,"q ""z"" ,",w"', '24,"","""o\n"', '25,"x"y"z,"k\n\n,"']
    lines += [f"{i},4\" pipe,x" for i in range(26, 40)]
    path = tmp_path / "t.csv"
    path.write_text("\n".join(lines) + "\n")
    with open(path, newline="") as f:
        want = sorted(r for r in list(csv.reader(f))[1:] if not r[0] == "25")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = sorted([x or "" for x in r] for r in read_raw_csv(spark, str(path), strict=True).collect())
        assert [r[0] for r in got] == sorted(str(i) for i in range(40))
        assert [r for r in got if r[0] != "25"] == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    flat = tmp_path / "flat.csv"
    flat.write_text('id,a\n1,3" pipe\n2,x\n')
    assert not has_broken_lines(spark, str(flat)) and read_raw_csv(spark, str(flat), strict=True).count() == 2
    never = tmp_path / "never.csv"
    never.write_text('id,a\n1,"x\n2,y\n')
    with pytest.raises(Exception, match="never closed"):
        read_raw_csv(spark, str(never)).collect()
