"""Removal of what operators leave behind: tables between their stages in the shared folder and in the warehouse.

Results are read from these tables as long as they are used, so nothing is removed by itself. Names end in 32 hexadecimal
digits; only such names of the operators are touched, and only what is older than asked for. A digest index is kept unless
``indexes`` is set: it is what later batches are compared with.
"""

from __future__ import annotations

import re
import time

from pyspark.sql import SparkSession

from loamstack.llm.store import shared_dir

FOLDER, TABLE, INDEX = r".+-[0-9a-f]{32}", r"(suffix_chunks|bpe_chunks|segments)_[0-9a-f]{32}", r"digest_index_[0-9a-f]{32}"


def _folders(spark: SparkSession, place: str) -> list[tuple[str, float, object, object]]:
    """Name, time of change, path and file system of what lies in a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [(s.getPath().getName(), s.getModificationTime() / 1000, s.getPath(), fs) for s in fs.listStatus(path)] if fs.exists(path) else []


def remove_intermediate(spark: SparkSession, hours: float = 24.0, indexes: bool = False) -> list[str]:
    """Remove intermediate tables that were last written ``hours`` ago or earlier; returns their names."""
    before, gone = time.time() - hours * 3600, []
    for name, changed, path, fs in _folders(spark, shared_dir(spark)):
        if re.fullmatch(FOLDER, name) and changed <= before:
            fs.delete(path, True)
            gone.append(name)
    written = {name: changed for name, changed, _, _ in _folders(spark, spark.conf.get("spark.sql.warehouse.dir"))}
    for table in spark.catalog.listTables():
        if (re.fullmatch(TABLE, table.name) or indexes and re.fullmatch(INDEX, table.name)) and written.get(table.name, before + 1) <= before:
            spark.sql(f"DROP TABLE IF EXISTS {table.name}")
            gone.append(table.name)
    return sorted(gone)
