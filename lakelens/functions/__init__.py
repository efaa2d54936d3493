"""Column builders shared by every operator."""
