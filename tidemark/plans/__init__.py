"""The composite queries, and the tables they run on."""
