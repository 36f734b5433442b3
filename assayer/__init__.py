"""A data-quality and geographic-reference engine on PySpark."""
