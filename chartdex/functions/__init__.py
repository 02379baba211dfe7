"""Column expressions: blanks, keys, codes, dates, ages, text and documents."""
