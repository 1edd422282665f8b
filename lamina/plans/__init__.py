"""The warehouse: bronze, silver and gold, publishing, and the daily run."""
