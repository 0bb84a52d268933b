"""The acronym dimension."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

COLUMN = "acronym_shrt"


def acronym_dim(spark: SparkSession, path: str) -> DataFrame:
    """Distinct acronyms of a Latin-1 CSV; empty where there is no file. A file without the column is an error."""
    try:
        table = spark.read.csv(path, header=True, encoding="ISO-8859-1")
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{COLUMN} string")
    return table.select(COLUMN).na.drop().distinct()
