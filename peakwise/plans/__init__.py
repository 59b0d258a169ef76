"""The user-level jobs composed from the operators."""
