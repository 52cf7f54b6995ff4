import io
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowmill.functions.columns import find_target, q
from flowmill.plans.prepare import Feature, PrepState, prepare
from flowmill.sources import csv_flows, files
from flowmill.sources import prepared as stored


def put(folder, name, text, encoding="utf-8"):
    with open(os.path.join(folder, name), "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_target_exact_folded_and_missing():
    assert find_target(["a", "Label"]) == "Label"
    assert find_target(["a", " label "], "Label") == " label "
    with pytest.raises(ValueError, match="none of the 2 columns"):
        find_target(["a", "b"], "Label")


def test_empty_folder_is_an_error(spark, folder):
    with pytest.raises(FileNotFoundError, match="no CSV files"):
        csv_flows.load_flows(spark, folder)


def test_headers_are_trimmed_and_repeats_numbered():
    assert csv_flows.header_names(" a,X,X, Label") == ["a", "X", "X.1", "Label"]
    with pytest.raises(ValueError, match="differ only in blanks"):
        csv_flows.header_names("a, a")


def test_files_with_other_column_order_are_aligned_by_name(spark, folder):
    put(folder, "one.csv", "a, b, Label\n1,2,x\n3,Infinity,y\n")
    put(folder, "two.csv", "Label,b,a\nz,NaN,5\n")
    df = csv_flows.load_flows(spark, folder)
    assert df.columns == ["a", "b", "Label"]
    assert dict(df.dtypes) == {"a": "double", "b": "double", "Label": "string"}
    rows = {r["Label"]: (r["a"], r["b"]) for r in df.collect()}
    assert rows["x"] == (1.0, 2.0) and rows["y"] == (3.0, float("inf")) and rows["z"] == (5.0, None)


def test_other_column_set_names_the_difference(spark, folder):
    put(folder, "one.csv", "a,b,Label\n1,2,x\n")
    put(folder, "two.csv", "a,c,Label\n1,2,x\n")
    with pytest.raises(ValueError, match=r"Missing: \['b'\]. Extra: \['c'\]"):
        csv_flows.load_flows(spark, folder)


def test_latin1_file_is_read_as_latin1(spark, folder):
    put(folder, "one.csv", "a,Label\n1,Web Attack – XSS\n")
    put(folder, "two.csv", "a,Label\n2,Café\n", encoding="latin-1")
    labels = {r["Label"] for r in csv_flows.load_flows(spark, folder).collect()}
    assert labels == {"Web Attack – XSS", "Café"}


def test_text_column_stays_text_and_declared_numbers_are_coerced(spark, folder):
    put(folder, "one.csv", "a,b,Label\n1,x1,p\n2,7,q\n")
    assert dict(csv_flows.load_flows(spark, folder).dtypes)["b"] == "string"
    forced = csv_flows.load_flows(spark, folder, numeric=["a", "b"])
    assert [r["b"] for r in forced.orderBy("a").collect()] == [None, 7.0]


QUOTED = (
    'n, name ,n,Label\r\n1,"a ""b"", c",2.5,BENIGN\r\n2,"two\nlines, ""quoted""\n\nend",,DoS\r\n3,,7,"Web, Attack"\r\n'
    '4,plain,NaN,"say ""x"""\r\n'
)


def test_quoted_cells_as_another_reader_sees_them(spark, folder):
    put(folder, "one.csv", QUOTED)
    want = pd.read_csv(io.StringIO(QUOTED.replace("\r\n", "\n")))
    want.columns = [c.strip() for c in want.columns]
    got = csv_flows.load_flows(spark, folder).orderBy("n").toPandas()
    assert list(got.columns) == list(want.columns)
    for c in want.columns:
        for a, b in zip(got[c], want[c], strict=True):
            assert (pd.isna(a) and pd.isna(b)) or (a == b), (c, a, b)


def test_short_rows_end_in_nulls_and_long_ones_are_an_error(spark, folder):
    put(folder, "one.csv", "a,b,Label\n1,2,x\n3\n")
    assert sorted(map(tuple, csv_flows.load_flows(spark, folder, numeric=["a", "b"]).collect())) == [
        (1.0, 2.0, "x"), (3.0, None, None)
    ]
    for surplus in ("5,6,y,7", "5,6,y,", "5,6,y,7,8"):
        put(folder, "two.csv", f"a,b,Label\n{surplus}\n")
        with pytest.raises(Exception, match="more than the header's 3 cells.*two.csv"):
            csv_flows.load_flows(spark, folder, numeric=["a", "b"]).select("a").collect()


def test_one_pass_tells_header_encoding_and_line_breaks(spark, folder):
    put(folder, "a.csv", 'x,Caf\u00e9\n1,"b\nc"\n', encoding="latin-1")
    put(folder, "b b.csv", "\ufeffx,y\n1,\u00e9\n")
    put(folder, "c.csv", "")
    seen = csv_flows.look_at(spark, csv_flows.find_csv_files(spark, folder))
    assert [(f.encoding, f.names, f.multiline) for f in seen] == [
        ("ISO-8859-1", ("x", "Caf\u00e9"), True), ("UTF-8", ("x", "y"), False), ("UTF-8", (), False)
    ]
    assert {f.encoding for f in csv_flows.look_at(spark, [f.path for f in seen], "UTF-8")} == {"UTF-8"}


def test_an_absent_report_is_empty(spark, folder):
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    assert files.read_json(spark, folder + "/none", schema).count() == 0
    files.write_json(spark.createDataFrame([(4,)], schema), folder + "/some")
    assert files.read_json(spark, folder + "/some", schema).first()["a"] == 4


def frame(spark, n=60):
    return spark.range(n).select(
        F.concat(F.lit("f"), F.col("id").cast("string")).alias("Flow ID"),
        (F.col("id") % 7).cast("double").alias("a.1"),
        (F.col("id") * F.col("id") % 11).cast("double").alias("b/s"),
        F.when(F.col("id") % 3 == 0, "DoS").otherwise("BENIGN").alias("Label"),
    )


def test_prepared_tables_and_state_round_trip(spark, folder):
    p = prepare(frame(spark), key="Flow ID", balancing="class_weight")
    stored.save_prepared(p, folder)
    train, test, state = stored.load_prepared(spark, folder)
    assert state == p.state
    assert train.count() == 48 and test.count() == 12
    assert sorted(map(tuple, train.collect())) == sorted(map(tuple, p.train.collect()))


def test_missing_prepared_parts_are_named(spark, folder):
    with pytest.raises(FileNotFoundError, match="train.*test"):
        stored.load_prepared(spark, folder)
    with pytest.raises(FileNotFoundError, match="no preparation state"):
        stored.load_state(spark, folder + "/nothing")


def test_other_column_order_is_an_error(spark):
    state = PrepState("Label", ("x",), (Feature("a", 0.0, 0.0, 1.0), Feature("b", 0.0, 0.0, 1.0)))
    df = spark.createDataFrame([(1.0, 2.0, "x")], "b double, a double, Label string")
    with pytest.raises(ValueError, match="column order"):
        stored.check_order(df, state)


def test_state_keeps_a_missing_median(spark, folder):
    state = PrepState("L", ("x", "y"), (Feature("a b", None, 0.0, 1.0),), ("Flow ID",), ("c",))
    stored.save_state(spark, state, folder)
    assert stored.load_state(spark, folder) == state


def test_report_is_one_json_file(spark, folder):
    files.write_json(spark.createDataFrame([(1, None)], "a int, b int"), folder + "/out")
    written = [f for f in os.listdir(folder + "/out") if f.endswith(".json")]
    assert len(written) == 1
    assert open(os.path.join(folder, "out", written[0])).read().strip() == '{"a":1,"b":null}'
    assert files.exists(spark, folder + "/out") and not files.exists(spark, folder + "/none")


def test_names_with_dots_and_slashes_resolve(spark):
    df = spark.createDataFrame([(1.0,)], "`Fwd Header Length.1` double")
    assert df.select(q("Fwd Header Length.1")).first()[0] == 1.0
