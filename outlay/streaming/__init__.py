"""The window load driven by newly landed interval folders."""
