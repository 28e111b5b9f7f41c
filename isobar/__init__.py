"""Analytics over gridded hourly observations, written as Spark DataFrame operators."""
