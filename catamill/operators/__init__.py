"""operators of catamill."""
