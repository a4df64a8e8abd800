"""Readers, file bookkeeping, column contracts, nested-object flattening and table writes."""
