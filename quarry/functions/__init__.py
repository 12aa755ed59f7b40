"""See the package docstring in quarry/__init__.py."""
