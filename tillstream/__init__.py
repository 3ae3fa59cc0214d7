"""Analytics over streams and tables of shop orders."""
