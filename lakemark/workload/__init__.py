"""The registered queries: stand-in inputs from the given tables, and oracles."""
