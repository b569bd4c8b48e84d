"""Installation-completeness analytics as PySpark DataFrame operators."""
