"""Tax-credit recovery analytics expressed as Spark DataFrame plans."""
