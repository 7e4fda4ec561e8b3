"""Perturbation experiments on cell-by-gene expression tables, as Spark jobs."""
