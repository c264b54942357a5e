"""Operators for large-scale training data: sketches, top N, batch de-duplication, packing, mixing and content scores."""
