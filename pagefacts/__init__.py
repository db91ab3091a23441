"""pagefacts: Spark operators that turn fetched job-board pages into clean job records."""
