"""Micro-batch scoring over a stream of orders."""
