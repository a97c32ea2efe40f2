"""Reusable distributed operators."""
