"""Stream forms of operators that keep no state."""
