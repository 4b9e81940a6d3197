"""Session settings the jobs rely on."""

import os

from pyspark.sql import SparkSession

# The cleansing projections cast a dozen and more columns at once.  Generated methods beyond 8,000
# bytes are never compiled by the JVM and run interpreted; below this limit Spark splits them.
DEFAULTS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def importable(spark: SparkSession) -> None:
    """Let workers that start from here on import this package, wherever the driver was started."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, known), home])


def tune(spark: SparkSession) -> SparkSession:
    """Apply the defaults, except where the session was given a value of its own."""
    importable(spark)
    given = dict(spark.sparkContext.getConf().getAll())
    for name, value in DEFAULTS.items():
        if name not in given:
            spark.conf.set(name, value)
    return spark
