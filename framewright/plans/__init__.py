"""Whole jobs, as the command line starts them."""
