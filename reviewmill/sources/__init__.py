"""Reading the feeds, writing and reading the stored tables, catalog registration."""
