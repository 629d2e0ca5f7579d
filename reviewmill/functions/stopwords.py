"""The default stop-word list; any other list comes in as a table."""

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession


def stopword_table(spark: SparkSession) -> DataFrame:
    """Spark ML's own English stop words, as a table."""
    words = StopWordsRemover.loadDefaultStopWords("english")
    return spark.createDataFrame([(word,) for word in words], "word string")
