import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from cases import ODD  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (id, text); the other columns follow."""

    def made(rows, partitions=3):
        full = [(i, t, "en", f"src{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return made


@pytest.fixture(scope="session")
def odd(docs):
    """Odd rows, with further columns whose names are those that the operators use themselves."""
    from pyspark.sql import functions as F

    clash = ("id", "key", "row", "_row", "_key", "kept", "score", "part", "_id", "fp", "count", "a", "e", "toxic", "_toxic", "_order", "n", "h1", "h2", "at", "_site", "_lines", "_at", "_slot", "_len", "_pre", "_full", "_norm", "_chars", "_n", "_best", "_hot", "u", "v", "class", "main", "best", "first", "ord", "cut", "asked", "place", "length", "piece", "base", "local", "own", "chars", "classes", "common", "n_words", "_url", "`tick`", "_text", "_0", "spans", "with space")
    return docs(ODD).select("*", *(F.lit(7).alias(c) for c in clash))


@pytest.fixture(scope="session")
def empty(docs):
    return docs([(0, "x")]).where("doc_id < 0")
