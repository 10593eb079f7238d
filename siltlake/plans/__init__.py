"""Layered jobs: bronze, silver, gold, and the runs that chain them."""
