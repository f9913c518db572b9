import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang), with columns whose names could clash."""
    def make(rows, clash=()):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "src0", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        for name in clash:
            df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


@pytest.fixture(scope="session")
def store(tmp_path_factory):
    """Write frames as <folder>/<name>.parquet and give the folder."""
    def write(**frames):
        folder = str(tmp_path_factory.mktemp("tables"))
        for name, df in frames.items():
            df.write.parquet(f"{folder}/{name}.parquet")
        return folder

    return write
