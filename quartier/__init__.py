"""Local-commerce analytics on Spark: star-schema ETL, OLAP reports, summaries and a relational sink."""
