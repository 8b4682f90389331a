"""Writers: landing files, model tables."""
