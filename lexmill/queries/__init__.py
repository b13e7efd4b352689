"""Queries over the given tables; importing the package registers all of them."""

from lexmill.queries import stores as stores
