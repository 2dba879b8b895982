"""wellspan subpackage."""
