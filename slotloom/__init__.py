"""Slot filling over document collections, written as Spark DataFrame jobs."""

from slotloom.slots import NO_VALUE, SLOTS

__all__ = ["NO_VALUE", "SLOTS"]
