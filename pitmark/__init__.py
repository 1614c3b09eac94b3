"""Point-in-time market research as lazy Spark DataFrame operators."""
