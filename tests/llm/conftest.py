import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (doc_id, text[, lang, source]) -> documents."""

    def build(*rows):
        full = [(*r, *(None,) * (4 - len(r)), None) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build
