"""Training-data pipeline operators (subpackage on its own: nothing else in the library imports it)."""
