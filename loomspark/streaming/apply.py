"""Recipes on streams: a fitted recipe is a projection, so a stream of rows is transformed as a batch is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.recipe import Recipe


def transformed(stream: DataFrame, recipe: Recipe, keep: Sequence[str] = ()) -> DataFrame:
    """The recipe's columns of a streaming DataFrame. No state is kept."""
    return recipe.transform(stream, keep)


def write(stream: DataFrame, recipe: Recipe, path: str, checkpoint: str, keep: Sequence[str] = (), available_now: bool = True) -> StreamingQuery:
    """Appends transformed rows as Parquet, each exactly once; available_now ends when the present input is done."""
    writer = transformed(stream, recipe, keep).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()
