"""A Spark-first engine for cleaning and measuring sparse catalogue records."""
