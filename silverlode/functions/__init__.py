"""Column helpers: text cleaning, safe casts, calendar arithmetic, measures and labels."""
