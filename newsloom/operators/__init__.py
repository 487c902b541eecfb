"""DataFrame operators of the collect job."""
