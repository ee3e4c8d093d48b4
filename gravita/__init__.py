"""Spatial demand engine: relational steps as Catalyst plans, numerical kernels as bounded pandas functions."""
