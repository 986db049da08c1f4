import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def make_docs(spark):
    """Documents with clashing extra columns, from {id: text} or [(id, text)]."""

    def make(texts, extra=""):
        rows = list(texts.items()) if isinstance(texts, dict) else list(texts)
        columns = DOCS + (f", {extra}" if extra else "")
        more = tuple(None for _ in extra.split(",") if extra)
        return spark.createDataFrame([(i, t, None, "src0", None if t is None else len(t), *more) for i, t in rows], columns)

    return make
