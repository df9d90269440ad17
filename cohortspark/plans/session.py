"""Session settings that the engine's plans run best with."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Fixed value: bytecode beyond which the JVM's compiler leaves a method to its interpreter.
#: Wider stages than that run by operator instead, in methods that are compiled.
HUGE_METHOD = "8000"


def tune(spark: SparkSession) -> SparkSession:
    """Sets what the user hasn't: the merge's rules are one very wide projection."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key) == "65535":
        spark.conf.set(key, HUGE_METHOD)
    return spark
