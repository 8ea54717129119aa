"""What the corpus operators share: the shared folder, written tables and document readers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reach_workers
from ..sources.shared import shared_dir, written  # noqa: F401

#: The white space that splits words everywhere in this subpackage: [\x20\x09-\x0D].
WHITE_SPACE = " \t\n\x0b\x0c\r"

#: Plan nodes that give the same rows in the same places whatever columns are asked for.
_STEADY = {"Project", "Filter", "Relation", "LocalRelation", "LogicalRDD", "Union", "SubqueryAlias"}


def steady(docs: DataFrame) -> DataFrame:
    """docs, such that monotonically_increasing_id() numbers its rows alike in each plan over it.

    That holds for tables that are read, projected and filtered. Anything else (a shuffle may deal rows out by what is
    left of them after column pruning) is written first.
    """
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    nodes = {line.lstrip(" +-:!'").split(" ", 1)[0].split("[", 1)[0] for line in plan.splitlines() if line.strip()}
    return docs if nodes <= _STEADY else written(docs, "rows")


def row_number() -> Column:
    return F.monotonically_increasing_id()


def named(column: str) -> Column:
    """A column by its name, whatever characters that has."""
    return F.col("`" + column.replace("`", "``") + "`")


def without_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """docs, which must be steady, less the rows whose number is in dropped (_key); columns may have any names."""
    plain = docs.select(*(named(c).alias(f"c{k}") for k, c in enumerate(docs.columns)), row_number().alias("_key"))
    return plain.join(dropped.select("_key"), "_key", "left_anti").drop("_key").toDF(*docs.columns)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(text_col: str) -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def map_batches(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    reach_workers(df.sparkSession)
    return df.mapInArrow(f, schema)


def id_type(df: DataFrame, id_col: str) -> str:
    return dict(df.dtypes)[id_col]


def slices(column: pa.Array, most_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a binary or string column that hold about most_bytes each, so that work space stays small."""
    start, held = 0, 0
    for i, n in enumerate(pc.binary_length(column).to_pylist()):
        held += n or 0
        if held >= most_bytes:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(column):
        yield start, len(column)
