"""granary: a Spark-first catalogue analytics engine."""
