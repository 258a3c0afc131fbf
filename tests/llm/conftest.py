import os
import sys

import pytest
from pyspark.sql import Row

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import prose  # noqa: E402


@pytest.fixture(scope="session")
def shared(spark, tmp_path_factory):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return spark


@pytest.fixture(scope="session")
def odd_docs(shared):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names clash with those of results."""
    base = prose(1, 120)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    texts = [
        (1, base), (2, base), (2, base), (3, near), (4, None), (5, ""), (6, " \n\t "), (7, "One"), (8, "two words"), (9, "TWO words"),
        (10, prose(2, 30_000)), (11, "x" * 200_000), (12, "a a a a a a"), (13, "\n".join(["same line here"] * 30)),
        (14, "### *** $$$ | | |"), (15, "日本語 テキスト é É"), (16, "<|endoftext|> it's  here\n\n ok"), (None, base), (None, None), (17, prose(3, 600)),
    ]
    rows = [Row(doc_id=i, text=t, lang="en" if i and i % 2 else None, source="s", n_words=-1, kept="?", shard=9, score="x", node=0, word=1) for i, t in texts]
    return shared.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int, kept string, shard int, score string, node int, word int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
