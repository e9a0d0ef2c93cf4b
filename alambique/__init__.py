"""Star-schema data quality, incremental load and loss reporting on PySpark."""

__version__ = "0.1.0"
