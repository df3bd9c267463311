"""Market-data capture analytics expressed as Spark DataFrame operators."""
