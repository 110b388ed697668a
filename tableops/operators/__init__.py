"""Operators that change tables: write, update, swap, rebuild."""
