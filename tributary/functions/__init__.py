"""Column functions: text, identifiers, dates, money and similarity."""
