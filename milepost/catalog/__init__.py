"""Driver queries: every operator on the driver tables, with an equivalent SQL where SQL can say it."""

from . import express, joins, keyed, merges, reasons, scalars, scale, services, survey, tracker
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
