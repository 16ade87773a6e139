"""Shared scratch storage and shipping of sources, as the library has them."""

from glosswork.session import ship_package
from glosswork.store import Scratch

__all__ = ["Scratch", "ship_package"]
