"""Named layer tables: create-or-replace by switching, and their upkeep.

A table is a catalog view over one folder of the shared location. A replace
writes a fresh folder first, partitioned and clustered like the table, and then
switches the view to it in one catalog operation. Readers planned before the
switch keep the files of the old folder, later ones see the new one, and a
build that fails leaves the old table as it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import scratch_path

YEAR = "_partition_year"


def create_or_replace(spark: SparkSession, name: str, df: DataFrame,
                      partition_by: str | None = None, cluster_by: tuple[str, ...] = ()) -> str:
    """Build ``df`` and make it the table ``name``; returns its folder.

    ``partition_by`` is a date column: rows go to folders by its year (one
    folder a day would be a few rows each) and range-clustered files by
    (date, ``cluster_by``), whose footers prune single days."""
    path = scratch_path(spark, name.split(".")[-1])
    columns = list(df.columns)
    keys = [*([YEAR, partition_by] if partition_by else []), *cluster_by]
    if partition_by:
        df = df.withColumn(YEAR, F.year(partition_by))
    if keys:
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    writer = df.write.partitionBy(YEAR) if partition_by else df.write
    writer.parquet(path)
    listed = ", ".join(f"`{c}`" for c in columns)
    layout = {"folder": path, "partition_by": partition_by or "", "cluster_by": ",".join(cluster_by)}
    shown = ", ".join(f"'marketlake.{k}' = '{v}'" for k, v in layout.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({shown}) "
              f"AS SELECT {listed} FROM parquet.`{path}`")
    return path


def layout_of(spark: SparkSession, name: str) -> dict[str, str]:
    """folder, partition_by and cluster_by of a table."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r.key.removeprefix("marketlake."): r.value for r in rows
            if r.key.startswith("marketlake.")}
