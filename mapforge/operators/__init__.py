"""Operators on element and feature DataFrames."""
