"""The query catalogue: each entry pairs a Spark query with an SQL statement of the same result."""
