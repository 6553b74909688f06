"""Reading, normalising and storing tables."""
