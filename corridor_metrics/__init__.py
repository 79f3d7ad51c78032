"""Traffic-signal performance measures as Spark DataFrame jobs."""
