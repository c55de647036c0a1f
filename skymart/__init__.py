"""Weather-observation analytics as Spark DataFrame operators."""
