from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gaugeline.session import build_session

    base = tmp_path_factory.mktemp("corpus")
    session = build_session(
        "corpus-tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def documents(spark):
    """Texts as a table; an extra column clashes with names that operators give."""

    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "en", "s", None if t is None else len(t), "x") for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score string")

    return make
