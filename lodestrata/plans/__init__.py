"""The five jobs, and the queries over the test tables."""
