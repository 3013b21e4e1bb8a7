"""Landing of listen files that arrive while the system runs."""
