"""DataFrame operators that know nothing about shops."""
