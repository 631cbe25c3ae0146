"""The stages over unbounded input."""
