"""Where ticks, bars and reports come from."""
