"""DataFrame operators: projection, cleaning, roll-up, deduplication, numbering, quality."""
