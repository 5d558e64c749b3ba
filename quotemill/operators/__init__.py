"""DataFrame operators on messages, trades and bars."""
