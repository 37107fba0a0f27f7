"""Column expressions: text keys, instants, decimals, raw JSON and personal data."""
