"""waymesh: road-network analytics expressed as Spark DataFrame plans."""
