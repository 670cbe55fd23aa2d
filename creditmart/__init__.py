"""Credit-risk datamart on Spark: raw extracts to bronze, silver and gold tables."""
