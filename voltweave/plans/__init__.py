"""Feature tables, named feature recipes and end-to-end workflows."""
