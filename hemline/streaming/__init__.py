"""Run-to-completion file and table streams."""
