"""DataFrame operators: flatten, separate, prune, row filters, keyed merges."""
