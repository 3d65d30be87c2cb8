"""Composed jobs: the profile, export, extract and Pareto report."""
