"""Executions of functions, their arguments, repeats and signatures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from croplake.catalog import ARGUMENT_FAMILIES
from croplake.operators.ranking import batches, null_safe_join
from croplake.session import cut_lineage, dealt, shuffled, tasks_for

#: argument families that count as inputs, and what they are called in a summary
INPUT_FAMILIES = {"observation_argument": "observation", "keyword_argument": "keyword",
                  "s3_input_argument": "s3", "http_argument": "http"}
_FAMILIES = {**INPUT_FAMILIES, "execution_key": "keys", "s3_output_argument": "s3_output"}
_RUN = ["function_id", "execution_id"]


def argument_items(arguments: dict[str, DataFrame]) -> DataFrame:
    """All arguments in one long table: function_id, execution_id, family, item (JSON).

    ``arguments`` maps family tables (and ``execution_key``) to DataFrames; absent families are
    empty. The item leaves out the two ids, so that equal arguments give equal items.
    """
    parts = []
    for family, df in arguments.items():
        columns = (
            ["geospatial_key_id", "temporal_key_id"] if family == "execution_key"
            else [c[0] for c in ARGUMENT_FAMILIES[family]]
        )
        # the same text for the same values, nulls included
        item = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
        parts.append(
            df.select(*_RUN, F.lit(_FAMILIES[family]).alias("family"), item.alias("item"))
        )
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def finished(execution: DataFrame, s3_output_argument: DataFrame) -> DataFrame:
    """Executions that have outputs."""
    return execution.join(s3_output_argument.select(*_RUN), _RUN, "left_semi")


def execution_summary(
    execution: DataFrame, s3_output_argument: DataFrame, arguments: dict[str, DataFrame]
) -> DataFrame:
    """Executions with outputs and keys, with the number of arguments per family.

    ``arguments`` holds the input families and ``execution_key``; ``n_<family>`` is 0 where an
    execution has none. Every family is counted per execution in one pass over the long table, so
    families do not multiply one another.
    """
    names = [*INPUT_FAMILIES.values(), "keys", "s3_output"]
    items = argument_items({**arguments, "s3_output_argument": s3_output_argument})
    counts = items.groupBy(*_RUN).agg(
        *[F.count_if(F.col("family") == n).alias(f"n_{n}") for n in names]
    )
    return (
        execution.join(shuffled(counts), _RUN)
        .filter((F.col("n_s3_output") > 0) & (F.col("n_keys") > 0))
        .select(*_RUN, *[f"n_{n}" for n in names])
    )


def execution_arguments(
    execution: DataFrame, s3_output_argument: DataFrame, arguments: dict[str, DataFrame],
    batch_size: int = 1000,
) -> DataFrame:
    """The argument lists behind :func:`execution_summary`, in arrays of at most ``batch_size``.

    One row per execution, family and batch, with {item, times} structs; a family an execution
    lacks has one empty array.
    """
    items = argument_items({**arguments, "s3_output_argument": s3_output_argument})
    # equal items shrink to one with its count; read for their numbers and for the lists
    counted = cut_lineage(items.groupBy(*_RUN, "family", "item").agg(F.count("*").alias("times")))
    sizes = cut_lineage(counted.groupBy(*_RUN, "family").agg(F.count("*").alias("n_rows")))
    packed = batches(
        counted, [*_RUN, "family"], ["item"], ["item", "times"], batch_size, "_rows", counts=sizes
    )
    has = sizes.groupBy(*_RUN).agg(
        *[F.bool_or(F.col("family") == n).alias(f"_{n}") for n in ("s3_output", "keys")]
    )
    done = execution.join(shuffled(has), _RUN).filter("_s3_output and _keys").select(*_RUN)
    names = [*INPUT_FAMILIES.values(), "keys", "s3_output"]
    all_families = done.withColumn("family", F.explode(F.array(*[F.lit(n) for n in names])))
    return all_families.join(shuffled(packed), [*_RUN, "family"], "left").select(
        *_RUN, "family", F.coalesce("batch", F.lit(0).cast("long")).alias("batch"),
        F.coalesce("_rows", F.array().cast(packed.schema["_rows"].dataType)).alias("arguments"),
    )


def raw_summary_counts(execution: DataFrame, arguments: dict[str, DataFrame]) -> DataFrame:
    """Rows per execution when all families are joined before they are grouped.

    That join holds one row per combination of arguments. Its size is the product of the family
    sizes and an execution lacking a family has none, so the count is had without the join.
    A row of a family with ``times`` stands for so many. A family without function_id is looked up
    in the executions, so that its rows count once for every row of theirs. All families are dealt
    out by execution and counted in one pass, in as many tasks as there are rows for.
    """
    names = [f"_n{i}" for i in range(len(arguments))]
    n_rows = F.col("_runs").cast("decimal(38,0)")
    if not names:
        return execution.groupBy(*_RUN).agg(F.count("*").alias("_runs")).select(*_RUN, n_rows.alias("n_rows"))
    rows = reduce(DataFrame.unionByName, [
        df.select(
            "execution_id", F.lit(n).alias("_family"),
            (F.col("times") if "times" in df.columns else F.lit(1)).cast("long").alias("_times"),
        )
        for n, df in zip(names, arguments.values())
    ])
    tasks = tasks_for(rows, execution)
    counts = dealt(rows, "execution_id", tasks=tasks).groupBy("execution_id").agg(
        *[F.sum(F.when(F.col("_family") == n, F.col("_times"))).alias(n) for n in names]
    )
    runs = dealt(execution.select(*_RUN), "execution_id", tasks=tasks).groupBy(*_RUN).agg(
        F.count("*").alias("_runs")
    )
    all_runs = F.sum("_runs").over(W.partitionBy("execution_id"))
    joined = runs.join(shuffled(counts.dropna()), "execution_id").withColumn("_all_runs", all_runs)
    for n, df in zip(names, arguments.values()):
        n_rows = (n_rows * F.col(n)).cast("decimal(38,0)")
        if "function_id" not in df.columns:
            n_rows = (n_rows * F.col("_all_runs")).cast("decimal(38,0)")
    return joined.select(*_RUN, n_rows.alias("n_rows"))


def raw_summary(execution: DataFrame, arguments: dict[str, DataFrame]) -> DataFrame:
    """What the joined families hold before they are grouped: (run, family, item, times).

    In the join every argument of a family meets every combination of the others'. How often it
    does is the number of joined rows by that of its own family, so the rows are given with their
    multiplicities and the join is never made. Executions lacking a family have no rows.
    """
    counted = argument_items(arguments).groupBy(*_RUN, "family", "item").agg(F.count("*").alias("_times"))
    counted = cut_lineage(counted)  # read for the sizes and for the items
    sizes = counted.groupBy(*_RUN, "family").agg(F.sum("_times").alias("_own"))
    joined = raw_summary_counts(execution, {
        n: counted.filter(F.col("family") == n).withColumnRenamed("_times", "times")
        for n in (_FAMILIES[family] for family in arguments)
    })
    return (
        counted.join(shuffled(sizes), [*_RUN, "family"]).join(shuffled(joined), _RUN)
        .select(*_RUN, "family", "item", (F.col("_times") * F.col("n_rows") / F.col("_own")).cast("long").alias("times"))
    )


def _item_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("execution_id", "family", "item").agg(F.count("*").alias("_times"))


def duplicate_executions(
    execution: DataFrame, arguments: dict[str, DataFrame], same_function: bool = False
) -> DataFrame:
    """Executions whose inputs equal an earlier one's: (execution_id, duplicate_of).

    Inputs are compared as multisets and the function may differ (``same_function`` asks for
    equality too); the earliest execution stands for all. Executions get a fingerprint that adds
    up over their items, so lists are neither sorted nor gathered; each execution is then compared
    item by item with the earliest one of its fingerprint, never with all others, so a chance
    equality of fingerprints cannot pass.
    """
    # read three times below: the arguments are counted once and written
    counted = cut_lineage(_item_counts(argument_items(arguments)))
    h1 = F.xxhash64("family", "item", "_times").cast("decimal(20,0)")
    h2 = F.xxhash64("_times", "item", "family", F.lit(1)).cast("decimal(20,0)")
    prints = counted.groupBy("execution_id").agg(
        F.count("*").alias("_n"), F.sum(h1).alias("_h1"), F.sum(h2).alias("_h2")
    )
    zero = F.lit(0).cast("decimal(30,0)")
    # executions without any input are equal to one another
    all_prints = cut_lineage(execution.select(*_RUN).join(shuffled(prints), "execution_id", "left").select(
        *_RUN, F.coalesce("_n", F.lit(0)).alias("_n"),
        F.coalesce("_h1", zero).alias("_h1"), F.coalesce("_h2", zero).alias("_h2"),
    ))
    key = ["_n", "_h1", "_h2"] + (["function_id"] if same_function else [])
    first = all_prints.groupBy(*key).agg(F.min("execution_id").alias("duplicate_of"))
    # many executions may share one fingerprint: the join shuffles by another expression than the
    # aggregate did, so that Spark may split it
    pairs = (
        null_safe_join(all_prints, shuffled(first), key)
        .filter(F.col("execution_id") != F.col("duplicate_of"))
        .select("execution_id", "duplicate_of", "_n")
    )
    theirs = counted.select(
        F.col("execution_id").alias("duplicate_of"), "family", "item", "_times"
    )
    # equal items per pair: with the same number of distinct items, all equal means same multiset
    equal = (
        pairs.join(shuffled(counted), "execution_id")
        .join(shuffled(theirs), ["duplicate_of", "family", "item", "_times"], "left_semi")
        .groupBy("execution_id", "duplicate_of").agg(F.count("*").alias("_equal"))
    )
    return (
        pairs.join(shuffled(equal), ["execution_id", "duplicate_of"], "left")
        .filter(F.coalesce("_equal", F.lit(0)) == F.col("_n"))
        .select("execution_id", "duplicate_of")
    )


def latest_functions(function: DataFrame) -> DataFrame:
    """The function row of the top minor version per (name, major, type)."""
    key = ["function_name", "major", "function_type_id"]
    rest = [c for c in function.columns if c not in key]
    top = F.max_by(F.struct(*rest), F.struct("minor", "function_id")).alias("_row")
    return function.groupBy(*key).agg(top).select(*key, "_row.*")


def latest_signatures(
    function: DataFrame, parameters: dict[str, DataFrame], batch_size: int = 1000
) -> DataFrame:
    """Typed inputs and outputs of the latest functions: function, family, batch, parameters.

    ``parameters`` maps a family (observation_inputs, keyword_inputs, s3_inputs, http_inputs,
    s3_outputs) to rows of function_id and the describing columns. S3 families carry driver and
    has_geometry of their own type, outputs those of the outputs.
    """
    latest = latest_functions(function).select(
        "function_id", "function_name", "major", "minor", "function_type_id"
    )
    parts = []
    for family, df in parameters.items():
        described = F.to_json(
            F.struct(*[c for c in df.columns if c != "function_id"]), {"ignoreNullFields": "false"}
        )
        parts.append(
            df.select("function_id", F.lit(family).alias("family"), described.alias("parameter"))
        )
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    rows = rows.join(latest.select("function_id"), "function_id", "left_semi")
    packed = batches(
        rows, ["function_id", "family"], ["parameter"], ["parameter"], batch_size, "_rows"
    )
    families = F.explode(F.array(*[F.lit(n) for n in parameters]))
    return latest.withColumn("family", families).join(
        packed, ["function_id", "family"], "left"
    ).select(
        *latest.columns, "family", F.coalesce("batch", F.lit(0).cast("long")).alias("batch"),
        F.coalesce(
            F.array_sort(F.transform("_rows", lambda r: r["parameter"])),
            F.array().cast("array<string>"),
        ).alias("parameters"),
    )


def s3_parameter_types(
    parameter: DataFrame, s3_type: DataFrame, s3_type_dataframe: DataFrame
) -> DataFrame:
    """S3 parameters of a function with the type's name and, for tables, driver and geometry."""
    return (
        parameter.join(s3_type, "s3_type_id")
        .join(s3_type_dataframe, "s3_type_id", "left")
        .select("function_id", "type_name", "driver", "has_geometry")
    )


def signature_difference(candidate: DataFrame, latest: DataFrame) -> DataFrame:
    """Parameters only one of two signatures has, repeats counted: side and the row."""
    only_new = candidate.exceptAll(latest).withColumn("side", F.lit("candidate"))
    only_old = latest.exceptAll(candidate).withColumn("side", F.lit("latest"))
    return only_new.unionByName(only_old)


def keyword_argument_rows(raw: DataFrame) -> DataFrame:
    """(function_id, execution_id, keyword_name, keyword_type, value text) as typed columns.

    Numbers (types INTEGER and FLOAT) go to ``value_number``, everything else to ``value_string``.
    """
    is_number = F.col("keyword_type").isin("INTEGER", "FLOAT")
    return raw.select(
        *_RUN, "keyword_name",
        F.when(is_number, F.col("value").cast("double")).alias("value_number"),
        F.when(~is_number, F.col("value")).alias("value_string"),
    )


def write_arguments(arguments: dict[str, DataFrame], folder: str) -> None:
    """Append every family to its table under ``folder``."""
    for family, df in arguments.items():
        df.write.mode("append").parquet(f"{folder}/{family}")

