"""Column builders: text forms, name normalisation, masks, seeded draws."""
