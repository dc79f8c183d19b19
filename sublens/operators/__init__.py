"""Relational building blocks that stay exact and evenly spread when a few keys are very hot."""
