"""Stateful and incremental operators."""
