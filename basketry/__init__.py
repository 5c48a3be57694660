"""Shop analytics on Spark: staging, star schema, RFM scores, quality checks, reports and models."""
