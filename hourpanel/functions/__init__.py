"""Column functions: wall clock and instant handling, tolerant casts, numeric guards."""
