"""Column functions: parsing, calendar parts, text, vectors and formatted verdicts."""
