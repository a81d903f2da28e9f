"""Forum analytics as Spark DataFrame operators: tables in, tables out."""

__version__ = "0.1.0"
