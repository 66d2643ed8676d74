import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2]))


@pytest.fixture
def docs(spark):
    """``docs(rows)``: a documents table of (doc_id, text, lang, source) rows, cut or filled up with nulls."""

    def make(rows, columns="doc_id bigint, text string, lang string, source string", parts=3):
        n = len(columns.split(","))
        full = [(*r, *[None] * (n - len(r)))[:n] for r in rows]
        return spark.createDataFrame(full, columns).repartition(parts)

    return make
