"""DataFrame operators: select, clean, encode, scale, profile, correlate, learn."""
