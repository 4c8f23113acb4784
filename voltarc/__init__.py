"""voltarc: fleet health analytics, declared as Spark DataFrame plans."""

__version__ = "0.1.0"
