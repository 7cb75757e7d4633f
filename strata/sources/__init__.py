"""Reading file batches and reading and writing tables."""
