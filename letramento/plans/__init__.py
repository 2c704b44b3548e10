"""Jobs (bronze, silver, gold) and the query catalogue."""
