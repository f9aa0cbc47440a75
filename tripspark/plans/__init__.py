"""Whole jobs: the test view, the staged jobs, publishing and benchmarks."""
