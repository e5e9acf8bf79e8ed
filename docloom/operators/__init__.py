"""Relational operators: anchors, figures, placement, chunking, index, metadata."""
