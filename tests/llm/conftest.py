import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source)."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make
