"""fraudlane: a Spark-native daily banking mart (SCD2 history, insert-only facts,
high-water marks) with a four-rule suspicious-operations report."""

__version__ = "0.1.0"
