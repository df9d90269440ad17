"""cohortspark: population-scale variant analytics as PySpark DataFrame and SQL plans."""
