import pytest
from pyspark.sql import Row

LONG = "Lorem ipsum dolor " * 400
ODD = [None, "", " ", "  ", "a  b", "a   b\n  c ", "\n\n x\ty \n ", "<|endoftext|> a<|endoftext|>", "É é e\u0301 …", "don't I'll 12345", "\u00a0 \u00a0x", LONG, "x" * 900]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeats, and columns whose names the operators use themselves."""
    rows = [Row(doc_id=i, text=t, n_tokens="z", ids=1, leaf=2, key="k") for i, t in enumerate([*ODD, "a  b", LONG])]
    rows += [Row(doc_id=4, text="a  b", n_tokens="z", ids=1, leaf=2, key="k"), Row(doc_id=None, text="null key", n_tokens=None, ids=None, leaf=None, key=None)]
    schema = "doc_id long, text string, n_tokens string, ids int, leaf int, key string"
    return spark.createDataFrame(rows, schema)
