"""Batch jobs and column operators for very large chess evaluation tables."""
