"""The end-to-end run, and the queries registered on the given tables."""
