"""Place-and-week surveillance analytics expressed as Spark DataFrame jobs."""
