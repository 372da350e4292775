"""Batch plans: the end-to-end jobs, the table adapter and the registered queries."""
