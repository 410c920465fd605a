"""Test-table views, registered queries and their SQL twins."""
