"""End-to-end plans: the pipeline, published tables and views, and the SQL
fixtures that derive the three inputs from the test tables."""
