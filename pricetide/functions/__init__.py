"""Column expressions: text, prices, dates, spec maps, page markup."""
