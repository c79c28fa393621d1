"""One query per operator over the given tables, and the same result in plain SQL."""
