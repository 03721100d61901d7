import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def docs(spark):
    """Documents from (id, text) pairs, with extra columns whose names clash
    with names that operators use inside."""
    def make(rows):
        out = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
        for name in ("fp", "rep", "n", "words", "key", "h1", "starts", "seq", "rid", "score", "ids", "term", "id", "line",
                     "want", "mv", "held_out", "kinds", "emptied", "component_id", "label"):
            out = out.withColumn(name, F.lit("clash"))
        return out
    return make


LONG = "omega " * 30_000 + "x" * 100_000


@pytest.fixture()
def messy(docs):
    """Null ids and texts, empty and blank texts, repeated rows, a very long text."""
    same = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    return docs([(1, None), (2, ""), (3, " \n\t "), (4, same), (4, same), (5, same + "\n" + same), (None, same),
                 (None, None), (6, LONG), (7, "é 中文 😀 <|endoftext|> 'tis"), (8, LONG)])
