"""Column level building blocks: calendar, bins, flags, geography, ratios."""
