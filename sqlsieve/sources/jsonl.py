"""Read JSON lines, skip what is not JSON, and split files again into equal parts."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from ..functions import rules
from ..functions.text import as_column, strip
from ..operators.corpus import CORPUS_SCHEMA
from ..operators.numbering import number_in_read_order, part_of

CHAT_SCHEMA = "messages array<struct<role:string,content:string>>"


def is_strict_json(line: Column | str) -> Column:
    """The line is one strict JSON value and nothing else.

    The parser accepts text after a value. Wrapped once as an array and once as an object, any
    such text breaks at least one of the two.
    """
    line = as_column(line)
    in_array = F.concat(F.lit("["), line, F.lit("]"))
    in_object = F.concat(F.lit('{"v":'), line, F.lit("}"))
    return F.try_parse_json(in_array).isNotNull() & F.try_parse_json(in_object).isNotNull()


def _lenient(line: Column) -> Column:
    """Valid for Python's reader. Built inside a function, so that it travels by value."""

    def ok(text: str | None) -> bool:
        if text is None:
            return False
        try:
            json.loads(text)
            return True
        except (ValueError, RecursionError):
            return False

    @F.pandas_udf(BooleanType())
    def loads(lines: pd.Series) -> pd.Series:
        return lines.map(ok).astype(bool)

    return loads(line)


def is_json(line: Column | str) -> Column:
    """Valid as a lenient reader sees it: NaN, infinities and repeated keys pass as well.

    Only lines that strict JSON refuses are looked at in Python.
    """
    line = as_column(line)
    strict = F.coalesce(is_strict_json(line), F.lit(False))
    return strict | _lenient(F.when(~strict, line))


def read_lines(spark: SparkSession, paths: list[str], glob: str = "*.jsonl") -> DataFrame:
    """Lines of all matching files below the folders, as ``value``."""
    return (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(paths)
    )


def parse_records(lines: DataFrame, schema: str) -> DataFrame:
    """Objects among valid lines, as columns; absent fields are null."""
    objects = lines.where(is_json("value") & F.col("value").rlike(r"\A\s*\{"))
    return objects.select(F.from_json("value", schema).alias("r")).select("r.*")


def read_corpus(spark: SparkSession, paths: list[str], glob: str = "*.jsonl") -> DataFrame:
    """Corpus records of many folders; the license may be one name or a list.

    Whole numbers are taken however they are written: 12, 12.0 and "12" are the same. A license
    that merely begins with a bracket is a name. Spark passes over files whose names begin with
    ``_`` or ``.``; rename such files to have them read.
    """
    numbers = [c.split()[0] for c in CORPUS_SCHEMA.split(", ") if c.endswith(" bigint")]
    schema = CORPUS_SCHEMA.replace("license array<string>", "license string")
    schema = schema.replace(" bigint", " string")
    records = parse_records(read_lines(spark, paths, glob), schema)
    listed = F.when(F.col("license").startswith("["), F.from_json("license", "array<string>"))
    names = F.coalesce(listed, F.when(F.col("license").isNotNull(), F.array("license")))

    def whole(name: str) -> Column:
        exact = F.expr(f"try_cast({name} as bigint)")
        rounded = F.expr(f"try_cast(try_cast({name} as double) as bigint)")
        return F.when(F.col(name).rlike(r"\A\s*[+-]?[0-9]+\s*\z"), exact).otherwise(rounded)

    return records.withColumns({"license": names} | {c: whole(c) for c in numbers})


def read_chat(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.schema(CHAT_SCHEMA).json(paths)


def numbered_lines(
    spark: SparkSession, path: str, rows_per_part: int = rules.RESPLIT_ROWS, glob: str = "*.jsonl"
) -> DataFrame:
    """Valid lines of each file below ``path``: ``source``, ``part``, ``line`` from 1, ``value``.

    ``source`` is the file's path below ``path`` without its suffix; files that differ in the
    suffix alone keep it. A big file is read in many blocks and no task sees all of it.
    """
    lines = read_lines(spark, [path], glob).select(
        strip("value").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    valid = lines.where((F.col("value") != "") & is_json("value"))
    numbered = number_in_read_order(valid, ["file"], "block", "line")
    below = F.regexp_replace("file", r"\A.*?\Q" + path.rstrip("/") + r"\E/*", "")
    stem = F.regexp_replace(below, r"\.[^./]*\z", "")
    files = numbered.select("file").distinct().select("file", below.alias("name"), stem.alias("stem"))
    shared = files.groupBy("stem").agg((F.count(F.lit(1)) > 1).alias("several"))
    named = files.join(shared, "stem").select(
        "file", F.when(F.col("several"), F.col("name")).otherwise(F.col("stem")).alias("source")
    )
    part = part_of("line", rows_per_part).alias("part")
    return numbered.join(named, "file").select("source", part, "line", "value")


def resplit(
    spark: SparkSession,
    path: str,
    out: str,
    rows_per_part: int = rules.RESPLIT_ROWS,
    glob: str = "*.jsonl",
) -> None:
    """Write the valid lines of each file below ``path`` as parts of ``rows_per_part``, in order.

    Lands in ``out/source=…/part=…``, apart from the input. A part, which is bounded, is written
    by one task.
    """
    (
        numbered_lines(spark, path, rows_per_part, glob)
        .repartition("source", "part")
        .sortWithinPartitions("source", "part", "line")
        .select("value", "source", "part")
        .write.partitionBy("source", "part")
        .text(out)
    )
