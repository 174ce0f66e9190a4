"""Micro-batches: the same steps as a batch, started and numbered."""
