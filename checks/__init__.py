"""Checks of the library by means that share no code with it."""
