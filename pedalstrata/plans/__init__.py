"""Composed plans: silver and gold layers, demand queries, end-to-end flows."""
