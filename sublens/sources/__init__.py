"""Where the input tables come from, and the types they are read as."""
