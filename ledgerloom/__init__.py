"""Order, payment and loyalty analytics expressed as Spark DataFrame plans."""
