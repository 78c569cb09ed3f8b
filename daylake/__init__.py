"""Delivery orders through a three-zone lake: source files, raw days, trusted days."""
