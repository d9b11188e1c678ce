import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())])


@pytest.fixture
def docs(spark, tmp_path):
    """(doc_id, text[, source]) rows as a written table with the columns of documents."""
    made = iter(range(100))

    def make(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s") for r in rows]
        path = str(tmp_path / f"docs-{next(made)}")
        spark.createDataFrame(full, DOCS).repartition(partitions).write.parquet(path)
        return spark.read.parquet(path)

    return make


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
