"""roadlens: connected-vehicle trip analytics expressed as Spark DataFrame operators."""
