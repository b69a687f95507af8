import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang) tuples."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make
