"""Snapshot quality, versioning and daily sales marts for order lines, on Spark."""
