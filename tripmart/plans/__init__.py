"""Whole runs, from raw files to marts, and the registered queries."""
