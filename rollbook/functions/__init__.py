"""Column expressions: null semantics, dates, text, numeric ranges, school fields."""
