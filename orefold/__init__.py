"""Sales warehouse on Spark: raw feeds, cleaned tables, star schema, checks."""
