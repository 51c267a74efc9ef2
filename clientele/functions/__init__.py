"""Column functions: text, dates and phone numbers."""
