import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, dealt over a few partitions."""
    def make(pairs, partitions=3):
        rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, DOC).repartition(partitions)
    return make


@pytest.fixture
def clash(docs):
    """The same with extra columns named like the operators' own."""
    def make(pairs, *names):
        df = docs(pairs)
        for i, name in enumerate(names):
            df = df.selectExpr("*", f"{i} AS `{name}`")
        return df
    return make
