"""The marts run over the given order tables, with an independent SQL answer for each query."""
