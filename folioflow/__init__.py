"""folioflow: document-archive analytics on Spark, as DataFrame and SQL plans."""
