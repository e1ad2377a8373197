"""End-to-end jobs: the weekly table run, the refresh from a file, the evaluation."""
