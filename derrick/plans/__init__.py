"""Marts and jobs: compositions of operators over the adapted tables."""
