"""Readers of landed files and of the tables made from them."""
