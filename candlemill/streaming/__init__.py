"""The load as a stream of arriving files."""
