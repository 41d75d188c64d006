import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from orderloom.session import build_session  # noqa: E402

SMALLEST = "/root/testdata/sf0.001"

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside; given as further columns of an input.
CLASHING = "fingerprint string, component string, gone string, rate string, in0 string, kept string"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALLEST}/documents.parquet").cache()


@pytest.fixture(scope="session")
def make_documents(spark):
    """Documents from (doc_id, text, source) rows, with further columns of clashing names."""

    def make(rows):
        full = [
            (i, text, "en", source, None if text is None else len(text), *["x"] * 6)
            for i, text, source in rows
        ]
        return spark.createDataFrame(full, f"{DOCUMENTS}, {CLASHING}")

    return make
