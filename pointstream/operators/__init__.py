"""DataFrame operators: frame decode, messages, lookup join, counts, ledgers."""
