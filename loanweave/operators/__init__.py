"""DataFrame operators of the loan analytics."""
