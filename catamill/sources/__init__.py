"""sources of catamill."""
