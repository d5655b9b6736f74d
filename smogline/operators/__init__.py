"""DataFrame-to-DataFrame operators, usable on batch tables and on streams."""
