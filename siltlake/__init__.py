"""Change-data lakehouse operators on Spark."""
