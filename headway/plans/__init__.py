"""Stage boundaries and the star-shaped warehouse the analytics read."""
