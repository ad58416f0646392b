"""paytide: instant-payment analytics expressed as Spark DataFrame jobs."""
