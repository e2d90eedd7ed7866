"""Whole plans: the warehouse build and the analytics queries over it."""
