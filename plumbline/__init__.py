"""Checks of a monthly full re-push of estimated sales, as Spark DataFrame jobs."""
