"""Where documents and tables come from, and where they go."""
