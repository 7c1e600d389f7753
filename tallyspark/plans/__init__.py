"""Registered queries over the driver tables, with the SQL that checks them."""
