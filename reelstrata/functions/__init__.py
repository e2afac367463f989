"""Column functions shared by the models."""
