"""streaming of catamill."""
