"""Market-data ingestion and analytics as Spark DataFrame operators."""
