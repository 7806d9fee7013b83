"""Sending this package's modules to Python workers that cannot import it from their own path."""

from tallyloom.functions.shipping import ship_package

__all__ = ["ship_package"]
