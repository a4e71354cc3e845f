"""Claims-shaped inputs derived from the star-schema test tables."""
