"""Readers, record projections, page parsing and writers."""
