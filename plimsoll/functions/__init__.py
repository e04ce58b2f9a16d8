"""Column builders: text, rates, hashing and status ladders."""
