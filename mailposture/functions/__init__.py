"""Column functions: record text, classification, names, page text."""
