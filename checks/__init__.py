"""Every job over the driver's tables, and the same results in plain SQL."""
