"""Medallion operators for order, payment, delivery and event data on PySpark."""
