"""functions of catamill."""
