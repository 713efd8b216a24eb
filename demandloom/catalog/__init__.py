"""Registered queries over the sample tables, with independent SQL for comparison."""
