"""labelloom: DataFrame operators for building, checking and routing labelled text on Spark."""

__version__ = "0.1.0"
