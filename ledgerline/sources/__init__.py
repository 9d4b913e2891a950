"""Landed JSON documents to typed rows, one module per vendor."""
