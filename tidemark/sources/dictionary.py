"""The shop dictionary as a source: a database table, or any table Spark can read."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import names as n


def jdbc_options(
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str,
    id_bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> dict[str, str]:
    """Options of a JDBC read. With `id_bounds` it is cut into `partitions` ranges of id;
    the bounds only set the cuts, no row is left out."""
    options = {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
    }
    if id_bounds is not None and partitions > 1:
        options.update(
            partitionColumn=n.DICTIONARY_ID,
            lowerBound=str(id_bounds[0]),
            upperBound=str(id_bounds[1]),
            numPartitions=str(partitions),
        )
    return options


def read_dictionary(
    spark: SparkSession,
    options: dict[str, str],
    source: str = "jdbc",
    id_column: str = n.DICTIONARY_ID,
    name_column: str = n.DICTIONARY_NAME,
) -> DataFrame:
    """Two columns, id and name; filters on them are left to the source."""
    return (
        spark.read.format(source)
        .options(**options)
        .load()
        .select(
            F.col(id_column).alias(n.DICTIONARY_ID), F.col(name_column).alias(n.DICTIONARY_NAME)
        )
    )
