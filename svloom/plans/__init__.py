"""The registered queries, by subject."""
