"""Reading and writing: stored tables, landing directories, FX payloads."""
