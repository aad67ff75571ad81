import numpy as np
import pytest


@pytest.fixture
def docs_df(spark):
    """A documents table with extra columns of clashing names."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", s, None if t is None else len(t), *["x"] * 8) for i, t, s in rows],
            "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, rest string, blocks string, "
            "score string, start string, key string, doc string, weight string",
        )

    return make


@pytest.fixture
def rng():
    return np.random.default_rng(7)
