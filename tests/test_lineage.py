from __future__ import annotations

from croplake.operators import lineage as li

RUN = "function_id long, execution_id long, "


def s3(spark, rows):
    return spark.createDataFrame(rows, RUN + "s3_type_id long, s3_object_id long")


def test_duplicates_are_multisets(spark):
    execution = spark.createDataFrame([(i, 1 + i % 2) for i in range(1, 8)], "execution_id long, function_id long")
    rows = s3(spark, [
        (2, 1, 5, 1), (2, 1, 5, 2), (1, 2, 5, 2), (1, 2, 5, 1),      # same in another order and function
        (2, 3, 5, 1), (2, 3, 5, 1), (1, 4, 5, 1),                    # twice against once
        (2, 5, 5, 1), (2, 5, 5, 1),                                  # same as 3
    ])
    args = {"s3_input_argument": rows}
    got = {r.execution_id: r.duplicate_of for r in li.duplicate_executions(execution, args).collect()}
    assert got == {2: 1, 5: 3, 7: 6}
    same = {r.execution_id: r.duplicate_of for r in li.duplicate_executions(execution, args, same_function=True).collect()}
    assert same == {5: 3}


def test_null_keyword_values_are_compared(spark):
    execution = spark.createDataFrame([(1, 1), (2, 1)], "execution_id long, function_id long")
    kw = spark.createDataFrame([(1, 1, "k", None, "a"), (1, 2, "k", 1.0, None)],
                               RUN + "keyword_name string, value_number double, value_string string")
    assert li.duplicate_executions(execution, {"keyword_argument": kw}).isEmpty()


def test_summary_needs_outputs_and_keys(spark):
    execution = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "execution_id long, function_id long")
    out = spark.createDataFrame([(1, 1, "o", 1, 1), (1, 1, "p", 1, 2), (1, 3, "o", 1, 1)],
                                RUN + "s3_output_parameter_name string, s3_type_id long, s3_object_id long")
    keys = spark.createDataFrame([(1, 1, 1, 1), (1, 2, 1, 1)], RUN + "geospatial_key_id long, temporal_key_id long")
    args = {"s3_input_argument": s3(spark, [(1, 1, 5, 1), (1, 1, 5, 2), (1, 1, 5, 2)]), "execution_key": keys}
    rows = li.execution_summary(execution, out, args).collect()
    assert [(r.execution_id, r.n_s3, r.n_s3_output, r.n_http) for r in rows] == [(1, 3, 2, 0)]
    lists = {r.family: r.arguments for r in li.execution_arguments(execution, out, args).collect()}
    assert sorted((a.item, a.times) for a in lists["s3"]) == [
        ('{"s3_type_id":5,"s3_object_id":1}', 1), ('{"s3_type_id":5,"s3_object_id":2}', 2),
    ]
    assert lists["http"] == []
    assert li.finished(execution, out).count() == 2
    raw = li.raw_summary_counts(execution, {"a": args["s3_input_argument"], "b": out}).collect()
    assert [(r.execution_id, int(r.n_rows)) for r in raw] == [(1, 6)]


def test_latest_signature(spark):
    function = spark.createDataFrame([(1, "f", 1, 0, 9), (2, "f", 1, 1, 9), (3, "f", 2, 0, 9)],
                                     "function_id long, function_name string, major int, minor int, function_type_id long")
    s3_type = spark.createDataFrame([(1, "table"), (2, "blob")], "s3_type_id long, type_name string")
    frame = spark.createDataFrame([(1, "CSV", False)], "s3_type_id long, driver string, has_geometry boolean")
    inputs = spark.createDataFrame([(2, 1), (2, 2), (1, 1)], "function_id long, s3_type_id long")
    outputs = spark.createDataFrame([(2, 2)], "function_id long, s3_type_id long")
    rows = li.latest_signatures(function, {
        "s3_inputs": li.s3_parameter_types(inputs, s3_type, frame),
        "s3_outputs": li.s3_parameter_types(outputs, s3_type, frame),
    }).collect()
    got = {(r.function_id, r.family): r.parameters for r in rows}
    assert set(got) == {(2, "s3_inputs"), (2, "s3_outputs"), (3, "s3_inputs"), (3, "s3_outputs")}
    assert got[2, "s3_inputs"] == [
        '{"type_name":"blob","driver":null,"has_geometry":null}',
        '{"type_name":"table","driver":"CSV","has_geometry":false}',
    ]
    # outputs describe the outputs
    assert got[2, "s3_outputs"] == ['{"type_name":"blob","driver":null,"has_geometry":null}']
    assert got[3, "s3_inputs"] == []


def test_signature_difference_counts_repeats(spark):
    new = spark.createDataFrame([("a",), ("a",), ("b",)], "type_name string")
    old = spark.createDataFrame([("a",), ("c",)], "type_name string")
    rows = sorted((r.side, r.type_name) for r in li.signature_difference(new, old).collect())
    assert rows == [("candidate", "a"), ("candidate", "b"), ("latest", "c")]


def test_keyword_types_and_writing(spark, tmp_path):
    raw = spark.createDataFrame([(1, 1, "n", "INTEGER", "3"), (1, 1, "j", "JSON", "{}")],
                                RUN + "keyword_name string, keyword_type string, value string")
    rows = li.keyword_argument_rows(raw)
    assert {r.keyword_name: (r.value_number, r.value_string) for r in rows.collect()} == {
        "n": (3.0, None), "j": (None, "{}"),
    }
    for _ in range(2):
        li.write_arguments({"keyword_argument": rows}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "keyword_argument")).count() == 4
