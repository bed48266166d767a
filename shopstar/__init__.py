"""Layered retail warehouse (bronze, silver, gold, marts) as Spark DataFrame operators."""
