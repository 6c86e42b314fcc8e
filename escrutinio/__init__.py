"""Election analytics on Spark: votes in, parliamentary seats out."""
