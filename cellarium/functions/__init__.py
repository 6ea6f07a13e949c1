"""Dimensions, recodes and column expressions."""
