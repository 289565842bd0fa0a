"""Column helpers: intervals, exact arithmetic, JSON text."""
