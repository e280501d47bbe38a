"""Column-expression builders: date / period parsing, ratios, name keys and similarity."""
